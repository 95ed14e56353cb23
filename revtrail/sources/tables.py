"""Readers for the input tables, with explicit schemas (no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

L, I, S, D = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()
TS = T.TimestampNTZType()


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TABLE_SCHEMAS: dict[str, T.StructType] = {
    "events": _st(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S),
                  ("value", D), ("props", S)),
    "documents": _st(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
    "conversations": _st(("conv_id", L), ("turn", L), ("role", S), ("text", S)),
    "pages": _st(("page_id", L), ("url", S), ("html", S)),
    "orders": _st(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S),
                  ("o_totalprice", D), ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": _st(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                    ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                    ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS)),
    "customer": _st(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                    ("c_mktsegment", S)),
    "supplier": _st(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _st(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I),
                ("p_retailprice", D)),
    "nation": _st(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "region": _st(("r_regionkey", I), ("r_name", S)),
    "labels": _st(("doc_id", L), ("quality", I), ("toxic", I)),
    "benchmark": _st(("item_id", L), ("text", S)),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = TABLE_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
