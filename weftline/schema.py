"""Closed vocabularies and table schemas of the property graph."""

from __future__ import annotations

from pyspark.sql import types as T

# Declaration keywords and the kinds they declare.
KINDS = {
    "package": "package", "part": "part", "action": "action", "state": "state", "port": "port", "item": "item", "attribute": "attribute",
    "requirement": "requirement", "calc": "calc", "analysis": "analysis", "connection": "connection", "interface": "interface", "view": "view",
    "viewpoint": "viewpoint", "enum": "enumeration", "concern": "concern", "constraint": "constraint", "flow": "flow", "allocation": "allocation",
    "event": "event", "metadata": "metadata", "use": "usecase", "rendering": "rendering", "verification": "verification", "snapshot": "snapshot",
    "timeslice": "timeslice", "occurrence": "occurrence",
}
# Words that may stand before a declaration keyword.
MODIFIERS = frozenset("private public protected abstract ref in out inout readonly derived end nonunique ordered library individual variation variant standard constant portion".split())
# Statements that their own comment closes.
COMMENT_HEADS = frozenset("doc comment rep language".split())
# Edge types and the relations of the domain.
EDGE_TYPES = ("RELATED_TO", "MENTIONED_IN", "PART_OF", "IN_COMMUNITY", "SUB_COMMUNITY_OF", "SIMILAR_TO")
RELATIONS = tuple("owns typedby specializes redefines satisfies refines derives performs subject exhibits connects transitionsto variantof imports sliceof sends dependson valueref".split())
#: Relations that a declaration states outright; only stated ones of these are kept.
DECLARED = ("owns", "typedby", "specializes", "redefines")

VALUE = T.StructType([T.StructField("value", T.DoubleType()), T.StructField("text", T.StringType()), T.StructField("unit", T.StringType()), T.StructField("expression", T.StringType())])
ATTRIBUTES = T.MapType(T.StringType(), VALUE)

ELEMENTS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("name", "qualified", "kind", "short", "typed")]
    + [T.StructField("specializes", T.ArrayType(T.StringType())), T.StructField("file", T.StringType()), T.StructField("line", T.IntegerType()), T.StructField("attributes", ATTRIBUTES)]
)
STATED = T.StructType([T.StructField("from", T.StringType()), T.StructField("to", T.StringType()), T.StructField("type", T.StringType()), T.StructField("file", T.StringType()), T.StructField("line", T.IntegerType())])

_S, _B, _I, _D = T.StringType(), T.BooleanType(), T.IntegerType(), T.DoubleType()
_VECTOR = T.ArrayType(T.FloatType())


def _table(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


ENTITIES = _table(
    _key=_S, entity_name=_S, entity_type=_S, description=_S, attributes=ATTRIBUTES, short_name=_S, source_file=_S, source_line=_I, files=T.ArrayType(_S), models=T.ArrayType(_S),
    stated=_B, clusters=T.ArrayType(_table(level=_I, cluster=_S)), import_number=_I, embedding=_VECTOR,
)
EDGES = _table(
    _key=_S, _from=_S, _to=_S, type=_S, relationship_type=_S, description=_S, weight=_D, order=_I, stated=_B, source_file=_S, source_line=_I, embedding=_VECTOR,
    analogy_role=_S, cosine=_D, rrf_score=_D, rank=_I,
)
DOCUMENTS = _table(_key=_S, file_name=_S, citable_url=_S, file_ids=_S, content=_S, files=T.ArrayType(_S), models=T.ArrayType(_S))
CHUNKS = _table(_key=_S, content=_S, tokens=_I, chunk_order_index=_I, full_doc_id=_S, files=T.ArrayType(_S), models=T.ArrayType(_S), embedding=_VECTOR)
FINDING = _table(summary=_S, explanation=_S)
COMMUNITIES = _table(_key=_S, title=_S, report_string=_S, level=_I, occurrence=_D, sub_communities=T.ArrayType(_S), report_json=_table(title=_S, summary=_S, rating=_D, rating_explanation=_S, findings=T.ArrayType(FINDING)))
