"""Messages and tag definitions shared by the tests."""

from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

MESSAGE_SCHEMA = "partition int, offset bigint, json string, source string"

ITEMS = '[{"_extract_code":"x","qty":1},{"_extract_code":"y","qty":2}]'
BODY = (
    '{"_extract_id":"A1","_extract_name":" gold ","EVNT_TS":"2024-01-01 00:00:07.179Z",'
    f'"_extract_items":{ITEMS}}}'
)
MESSAGES = [
    (0, 1, BODY, "t"),
    (0, 2, BODY, "t"),
    (0, 3, '{"EVNT_TS":"2024-01-01 00:00:08.000Z"}', "t"),
    (1, 1, '{"_extract_id":"A2","EVNT_TS":"bad"}', "t"),
    (2, 1, "not json", "t"),
    (3, 3000000000, '{"_extract_id":"A3"}', "t"),
]

PROD_SCHEMA = StructType(
    [
        StructField("_extract_id", StringType()),
        StructField("_extract_name", StringType()),
        StructField("EVNT_TS", StringType()),
        StructField(
            "_extract_items",
            ArrayType(
                StructType(
                    [StructField("_extract_code", StringType()), StructField("qty", IntegerType())]
                )
            ),
        ),
    ]
)

FLATTEN = """
SELECT id, name, EVNT_TS, item.code AS code, item.qty AS qty
FROM {prod} LATERAL VIEW OUTER explode(items) t AS item
"""


def messages(spark, rows=None):
    return spark.createDataFrame(MESSAGES if rows is None else rows, MESSAGE_SCHEMA)


def rows(df):
    """The rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
