"""The registered queries of the training-data operators, and their SQL where it has any."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from .ann import nearest
from .bpe import encode_digests
from .chat_format import examples, format_conversations, read_turns, reply
from .common import table
from .exact_dedup import exact_dedup
from .html_extract import extract_pages
from .language_id import HELD_OUT, fit_languages, fold as language_fold, identify
from .license_scan import BASE, TEMPLATES, license_scan
from .lm_score import lm_score
from .near_dup import near_duplicates
from .packing import pack
from .point_in_time import micros, point_in_time
from .prefix_trie import prefix_trie, rebuilt, turn_lists
from .quality import fit_quality, fold, score_quality

WORD_BPE = "word_bpe_49k.json"
#: Documents of a lower score are rejected.
KEEP_SCORE = 0.3


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(WORD_BPE)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="max")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    formatted = format_conversations(rows.unionByName(own))
    turns = formatted.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), read_turns(F.col("formatted")).alias("turns"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    turns = turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), "formatted_chars")
    each = examples(formatted).select("conv_id", F.struct("example_no", reply(F.col("text"), F.col("start"), F.col("length")).alias("reply")).alias("e"))
    loss = each.groupBy("conv_id").agg(F.array_join(F.sort_array(F.collect_list("e"))["reply"], "").alias("loss"))
    joined = turns.join(loss.withColumnRenamed("conv_id", "loss_conv"), F.col("conv_id").eqNullSafe(F.col("loss_conv")), "left")
    text = F.coalesce("loss", F.lit(""))
    return joined.select("conv_id", "n_turns", "turns_sha256", F.length(text).cast("long").alias("loss_chars"), F.sha2(text, 256).alias("loss_sha256"), "formatted_chars")


def op11_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = table(spark, sf_dir, "sales")
    late = F.pmod(F.crc32(F.col("sale_id").cast("string").cast("binary")), F.lit(259_200)) * 1_000_000
    moments = sales.select(F.col("client_id").alias("client"), F.col("sale_id").alias("id"), (micros(sales, "sold_at") + late).alias("t_us"))
    found = point_in_time(moments, table(spark, sf_dir, "clicks"), sales, table(spark, sf_dir, "sale_lines"))
    return found.withColumnRenamed("id", "sale_id")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(language_fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return identify(docs, fit_languages(docs)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(turn_lists(table(spark, sf_dir, "conversations"))))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_near_dup": op2_near_dup,
    "op3_html_extract": op3_html_extract,
    "op4_nearest": op4_nearest,
    "op5_bpe": op5_bpe,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_packing": op7_packing,
    "op8_lm_score": op8_lm_score,
    "op9_quality": op9_quality,
    "op10_chat_format": op10_chat_format,
    "op11_point_in_time": op11_point_in_time,
    "op12_language_id": op12_language_id,
    "op13_prefix_trie": op13_prefix_trie,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SAID = "</s>[INST] ok [/INST]"
_SIZE = "length({0}) + length({0}) - length(replace(replace(replace({0}, '~', ''), '<', ''), '[', ''))"

_PHRASES = ", ".join(f"('{label}', {phrase.split()})" for phrase, label in BASE.items())


def _template_words() -> str:
    """A row for each distinct word of each template: how many words it has, how many must be met, and within how many."""
    rows = []
    for rule, (label, share, text) in enumerate(TEMPLATES):
        own, length = sorted(set(text.split())), len(text.split())
        need, reach = math.ceil(share * len(own) - 1e-9), math.ceil(length / share - 1e-9)
        rows += [f"({rule}, '{label}', '{w}', {len(own)}, {need}, {reach})" for w in own]
    return ", ".join(rows)


# CRC-32 of the decimal text of a whole number
_CRC = """(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
    lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295))"""

SQL = {
    "op11_point_in_time": f"""
        WITH m AS (SELECT sale_id, client_id, epoch_us(sold_at) + {_CRC.format('sale_id')} % 259200 * 1000000 AS t FROM sales
                   WHERE client_id IS NOT NULL AND sold_at IS NOT NULL AND sale_id IS NOT NULL),
        w(d, len) AS (VALUES (2, 172800000000), (14, 1209600000000)),
        s AS (SELECT sale_id, client_id, epoch_us(sold_at) AS ts, epoch_us(arrived_at) + 14400000000 AS known, CAST(coalesce(floor(100 * total + 0.5), 0) AS BIGINT) AS cents FROM sales WHERE sold_at IS NOT NULL),
        c AS (SELECT client_id, epoch_us(ts) AS ts, epoch_us(arrived_at) + 14400000000 AS known, click_id, kind, CAST(coalesce(floor(100 * "value" + 0.5), 0) AS BIGINT) AS cents FROM (SELECT DISTINCT * FROM clicks)),
        l AS (SELECT s.client_id, s.ts, greatest(s.known, epoch_us(shipped_at)) AS known, item_id, CAST(coalesce(floor(100 * amount + 0.5), 0) AS BIGINT) AS cents FROM sale_lines JOIN s USING (sale_id) WHERE shipped_at IS NOT NULL AND s.known IS NOT NULL),
        fc AS (SELECT m.sale_id, d, count(*) AS n_clicks, count(*) FILTER (WHERE kind = 'purchase') AS n_purchases, sum(cents)::BIGINT AS click_cents, max({{'a': c.ts, 'b': click_id}}).b AS last_click_id
               FROM m, w, c WHERE c.client_id = m.client_id AND c.ts <= t AND c.ts > t - len AND c.known <= t GROUP BY ALL),
        fs AS (SELECT m.sale_id, d, count(*) AS n_sales, sum(cents)::BIGINT AS sale_cents FROM m, w, s WHERE s.client_id = m.client_id AND s.ts <= t AND s.ts > t - len AND s.known <= t GROUP BY ALL),
        fl AS (SELECT m.sale_id, d, count(*) AS n_lines, count(DISTINCT item_id) AS n_items, sum(cents)::BIGINT AS line_cents FROM m, w, l WHERE l.client_id = m.client_id AND l.ts <= t AND l.ts > t - len AND l.known <= t GROUP BY ALL)
        SELECT m.sale_id, w.d, m.t AS t_us, EXISTS (SELECT 1 FROM s WHERE s.client_id = m.client_id AND s.ts > m.t AND s.ts <= m.t + 604800000000) AS label,
               coalesce(n_clicks, 0) AS n_clicks, coalesce(n_purchases, 0) AS n_purchases, coalesce(click_cents, 0) AS click_cents, last_click_id,
               coalesce(n_sales, 0) AS n_sales, coalesce(sale_cents, 0) AS sale_cents, coalesce(n_lines, 0) AS n_lines, coalesce(n_items, 0) AS n_items, coalesce(line_cents, 0) AS line_cents
        FROM m CROSS JOIN w LEFT JOIN fc ON fc.sale_id = m.sale_id AND fc.d = w.d LEFT JOIN fs ON fs.sale_id = m.sale_id AND fs.d = w.d LEFT JOIN fl ON fl.sale_id = m.sale_id AND fl.d = w.d""",
    "op13_prefix_trie": f"""
        WITH conv AS (SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ts
                      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        cut AS (SELECT c, ts, c - c % 100 AS p, {_CRC.format('c')} % 6 AS h FROM conv),
        r AS (SELECT cut.c, list_concat(coalesce(head.ts[1 : h], []), cut.ts[h + 1 :]) AS ts FROM cut LEFT JOIN conv head ON head.c = cut.p),
        begun AS (SELECT c, unnest(range(0, len(ts) + 1)) AS d, ts FROM r),
        node AS (SELECT ts[1 : d] AS p, d, min(c) AS conv_id, count(*) AS n, (count(*) - 1) * coalesce(any_value(length(ts[d].t)), 0) AS own,
                        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(ts) = d), '')) AS ends FROM begun GROUP BY ts[1 : d], d),
        child AS (SELECT p[1 : d - 1] AS p, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
        told AS (SELECT node.*, coalesce(child.n, 0) AS n_children FROM node LEFT JOIN child ON child.p = node.p AND child.d = node.d),
        below AS (SELECT p[1 : k] AS p, k AS d, sum(own) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM told) GROUP BY ALL)
        SELECT told.conv_id, told.d AS depth, above.conv_id AS parent_conv_id, told.n AS n_convs, told.n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens, told.ends AS ends_sha256
        FROM told JOIN below ON below.p = told.p AND below.d = told.d LEFT JOIN node above ON above.p = told.p[1 : told.d - 1] AND above.d = told.d - 1""",
    "op1_license_scan": f"""
        WITH w AS (SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM documents),
        tok AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM w),
        phrase(label, ps) AS (VALUES {_PHRASES}),
        tw(rule, label, word, size, need, reach) AS (VALUES {_template_words()}),
        base AS (SELECT t.doc_id, label, pos FROM tok t JOIN phrase ON word = ps[1] JOIN w ON w.doc_id = t.doc_id WHERE ws[pos + 1 : pos + len(ps)] = ps),
        held AS (SELECT doc_id, pos, rule, label, word, size, need, reach FROM tok JOIN tw USING (word)),
        able AS (SELECT doc_id, rule FROM held GROUP BY doc_id, rule, size, need HAVING count(DISTINCT word) >= need),
        able_held AS (SELECT held.* FROM held JOIN able USING (doc_id, rule)),
        hit AS (SELECT x.doc_id, x.label, count(DISTINCT y.word) / any_value(x.size) AS score
                FROM able_held x JOIN able_held y ON y.doc_id = x.doc_id AND y.rule = x.rule AND y.pos >= x.pos AND y.pos < x.pos + x.reach
                GROUP BY x.doc_id, x.rule, x.label, x.pos HAVING count(DISTINCT y.word) >= any_value(x.need)),
        b AS (SELECT doc_id, count(*) AS n, min(pos) AS lo, max(pos) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY doc_id),
        l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
              FROM (SELECT doc_id, label, 1.0::DOUBLE AS score FROM base UNION ALL SELECT * FROM hit) GROUP BY doc_id)
        SELECT w.doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word, coalesce(b.labels, '') AS base_labels,
               coalesce(l.labels, '') AS labels, coalesce(score, 0.0) AS score
        FROM w LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id)""",
    "op10_chat_format": f"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '{_SAID}' UNION ALL SELECT -7, 1, 'assistant', '{_SAID}')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(11 + length(role) + {_SIZE.format('text')}) AS BIGINT) AS formatted_chars
        FROM t GROUP BY conv_id""",
    "op2_near_dup": f"""
        WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
        gram AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(generate_series(1, len(ws) - 4), lambda i: array_to_string(ws[i : i + 4], ' '))
                                                WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] END) AS g FROM w),
        size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
        link AS (
            SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM gram x JOIN gram y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
            JOIN size na ON na.doc_id = a JOIN size nb ON nb.doc_id = b WHERE 100 * shared >= 80 * (na.n + nb.n - shared)),
        reach AS (SELECT doc_id, doc_id AS root FROM w UNION SELECT b, root FROM reach JOIN link ON a = doc_id WHERE root < b)
        SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id FROM reach LEFT JOIN size USING (doc_id) GROUP BY doc_id""",
    "op6_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
        FROM (SELECT doc_id, {_LOWER} AS norm FROM documents)
        WINDOW g AS (PARTITION BY norm)""",
}
