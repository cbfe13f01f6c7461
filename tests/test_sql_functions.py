"""The SQL functions agree with the DataFrame functions."""

from pyspark.sql import functions as F

from recordsmith.functions import jsonparse as J
from recordsmith.functions import scoring as S
from recordsmith.functions.register import register_functions

TEXTS = ['{"can_extract": true, "record": {"a": 1, "b": ""}}', 'x {"can_extract": false} y', "[1]", "nope",
         '{"can_extract": 1, "record": {"a": [1, {"b": 2.0}]}}']


def test_sql_functions_match_dataframe_functions(spark):
    register_functions(spark)
    df = spark.createDataFrame([(t,) for t in TEXTS], "raw string")
    df.createOrReplaceTempView("raw_outputs")
    sql = spark.sql("""
        SELECT raw, rs_canonical_json(rs_extract_json_block(raw)) AS c,
               rs_confidence(rs_extract_json_block(raw)) AS conf,
               rs_refusal_correct(rs_extract_json_block(raw), parse_json('{"can_extract": true}')) AS ok,
               size(rs_flatten_json(rs_extract_json_block(raw))) AS n
        FROM raw_outputs""")
    p = df.select("raw", J.extract_json_block("raw").alias("p"))
    api = p.select("raw", J.canonical_json("p").alias("c"), S.confidence(F.col("p")).alias("conf"),
                   S.refusal_correct(F.col("p"), F.parse_json(F.lit('{"can_extract": true}'))).alias("ok"),
                   F.size(J.flatten_leaves("p")).alias("n"))
    assert sorted(sql.collect()) == sorted(api.collect())
