"""Requests at once: a bound for all tasks together, order, retries and what is not tried again."""

import json
import threading
import time
import urllib.error
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from pairscore.sources.asking import Limits, answers, may_pass, patiently
from pairscore.sources.models import ChatModel, ask_model, generate_answers, score_answers

CHUNKS = "doc_id string, chunk_idx int, chunk_id string, page_hint string, title_path array<string>, text string"


class Server:
    """Answers each prompt by its last word after a while, and remembers how many were being answered at once. The first
    request of prompts that say so is turned away."""

    def __enter__(self):
        own, self.now, self.most, self.asked, self.lock = self, 0, 0, {}, threading.Lock()

        class Handler(BaseHTTPRequestHandler):
            def do_POST(self):  # noqa: N802
                prompt = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["messages"][-1]["content"]
                with own.lock:
                    own.now += 1
                    own.most = max(own.most, own.now)
                    own.asked[prompt] = own.asked.get(prompt, 0) + 1
                    code = 503 if "busy" in prompt and own.asked[prompt] < 3 else 400 if "wrong" in prompt else 200
                time.sleep(0.05)
                with own.lock:
                    own.now -= 1
                self.send_response(code)
                self.end_headers()
                if code == 200:
                    self.wfile.write(json.dumps({"choices": [{"message": {"content": prompt.split()[-1]}}]}).encode())

            def log_message(self, *_):
                pass

        class Many(ThreadingHTTPServer):
            request_queue_size = 256

        self.server = Many(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.model = ChatModel(f"http://127.0.0.1:{self.server.server_port}", "k", "m")
        return self

    def __exit__(self, *_):
        self.server.shutdown()
        self.server.server_close()


def chunks(spark, texts):
    return spark.createDataFrame([("d", i, f"c{i}", "1", [], t) for i, t in enumerate(texts)], CHUNKS)


@pytest.mark.parametrize(("bound", "least"), [(16, 9), (3, 2)])
def test_no_more_at_once_than_the_bound(spark, bound, least):
    """More than the session's four cores for 16, fewer for 3."""
    with Server() as server:
        rows = ask_model(chunks(spark, [f"text w{i}" for i in range(150)]), server.model, bound).collect()
        assert {(r.chunk_idx, r.error) for r in rows} == {(i, None) for i in range(150)}
        assert all(r.raw_response for r in rows) and least <= server.most <= bound
        server.most = 0
        batches = spark.createDataFrame([("c", i, 20, "d") for i in range(60)], "category string, batch_id int, count int, description string")
        told = generate_answers(batches, server.model, bound)
        assert told.count() == 60 and server.most <= bound


def test_busy_servers_are_asked_again_and_wrong_requests_are_not(spark):
    with Server() as server:
        rows = {r.chunk_idx: r for r in ask_model(chunks(spark, ["busy a", "wrong b", "good c"]), server.model, Limits(4, 3, 0.01)).collect()}
        assert rows[0].error is None and rows[2].error is None and rows[1].error.startswith("HTTPError") and rows[1].raw_response == ""
        assert sorted(server.asked.values()) == [1, 1, 3]
        few = {r.chunk_idx: r.error for r in ask_model(chunks(spark, ["busy d"]), server.model, Limits(4, 2, 0.01)).collect()}
        assert few[0].startswith("HTTPError")
        answers_ = spark.createDataFrame([("c", 1, "wrong?"), ("c", 2, " \n")], "category string, batch_id int, text string")
        assert score_answers(answers_.where("batch_id = 2"), server.model, 2).collect() == []
        with pytest.raises(Exception, match="HTTP"):
            score_answers(answers_, server.model, 2).collect()


def test_answers_keep_their_order_and_errors_their_place():
    def ask(x):
        time.sleep(0.02 if x == "a" else 0)
        if x == "b":
            raise ValueError("no")
        return x * 2

    got = list(answers(ask, [("a",), ("b",), ("c",)], 3, Limits()))
    assert [a for a, _ in got] == ["aa", "", "cc"] and isinstance(got[1][1], ValueError)


def test_pauses_double():
    waits, began = [], time.perf_counter()

    def ask():
        waits.append(time.perf_counter() - began)
        raise TimeoutError

    with pytest.raises(TimeoutError):
        patiently(ask, Limits(1, 4, 0.02))
    assert len(waits) == 4 and 0.13 < waits[-1] < 2
    assert not may_pass(ValueError()) and may_pass(urllib.error.URLError("x"))
