"""Schemas of all tables, as DDL. Nothing is inferred."""

from __future__ import annotations

EVIDENCE = "struct<page:string,text:string>"
RELATION = "struct<relation:string,target:string>"
ENTITY = f"struct<name:string,type:string,aliases:array<string>,attributes:map<string,string>,relations:array<{RELATION}>,evidence:array<{EVIDENCE}>>"
COUNTS = "struct<tp:bigint,fp:bigint,fn:bigint>"

#: One row per document.
DOCUMENT = "doc_id string, text string"
#: A chunk's key is (doc_id, chunk_idx); chunk_id is its printed name, unique within a document.
CHUNK = "doc_id string, chunk_idx int, chunk_id string, page_hint string, title_path array<string>, text string"
RESPONSE = "doc_id string, chunk_idx int, chunk_id string, page_hint string, title_path array<string>, raw_response string, error string, model_name string"
EXTRACTION = f"doc_id string, chunk_idx int, chunk_id string, page_hint string, title_path array<string>, entities array<{ENTITY}>, raw_response string, error string, model_name string"
#: Without a doc_id a gold record is for the only document of a run.
GOLD = f"doc_id string, chunk_id string, entities array<{ENTITY}>"
TASK = "task_idx int, category string, count int, description string"
BATCH = "task_idx int, category string, count int, description string, batch_id int"
QUESTION = "category string, question string, score int"

# The kinds of scoring errors, in report order.
ERROR_TYPES = (
    "missing_entity",
    "extra_entity",
    "wrong_type",
    "missing_attribute",
    "wrong_attribute_value",
    "wrong_relation",
    "wrong_attachment",
)
# The fields of each kind's rows.
ERROR_FIELDS = {
    "missing_entity": ("name", "type"),
    "extra_entity": ("name", "type"),
    "wrong_type": ("name", "reference_type", "prediction_type"),
    "missing_attribute": ("entity", "attribute", "value"),
    "wrong_attribute_value": ("entity", "attribute", "reference_value", "prediction_value"),
    "wrong_relation": ("subject", "relation", "target"),
    "wrong_attachment": ("predicted_entity", "attribute", "value", "likely_entity"),
}
LEVELS = ("entity", "attribute", "relation")
ERROR = "struct<error_type:string,seq:int,payload:map<string,string>>"
# The entity types a model is asked to prefer; others are accepted.
ENTITY_TYPES = (
    "submarine_class", "submarine_model", "submarine_ship", "missile", "torpedo", "sonar", "radar",
    "navigation_system", "command_system", "propulsion_system", "compartment", "equipment",
)
DEFAULT_TYPE = "equipment"
