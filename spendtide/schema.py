"""Schemas of the landed pages and of the cost fact table."""

from pyspark.sql import types as T

from spendtide.functions.numbers import EXACT

COST_METRIC = "UnblendedCost"

RAW_PAGES = T.StructType([
    T.StructField("ResultsByTime", T.ArrayType(T.StructType([
        T.StructField("TimePeriod", T.StructType([
            T.StructField("Start", T.StringType()),
            T.StructField("End", T.StringType()),
        ])),
        T.StructField("Groups", T.ArrayType(T.StructType([
            T.StructField("Keys", T.ArrayType(T.StringType())),
            T.StructField("Metrics", T.MapType(T.StringType(), T.StructType([
                T.StructField("Amount", T.StringType()),
                T.StructField("Unit", T.StringType()),
            ]))),
        ]))),
    ]))),
    T.StructField("NextPageToken", T.StringType()),
])

# The eight extracted columns; amounts land as text.
COST_EXTRACT = T.StructType([
    T.StructField("SERVICE", T.StringType()),
    T.StructField("TAG", T.StringType()),
    T.StructField("METRIC", T.StringType()),
    T.StructField("GRANULARITY", T.StringType()),
    T.StructField("STARTDATE", T.DateType()),
    T.StructField("ENDDATE", T.DateType()),
    T.StructField("USD", T.StringType()),
    T.StructField("UNIT", T.StringType()),
])

COST_FACT = T.StructType([
    T.StructField(f.name, T.DoubleType() if f.name == "USD" else f.dataType)
    for f in COST_EXTRACT
] + [T.StructField(part, T.IntegerType()) for part in ("DAY", "WEEK", "MONTH", "YEAR")])


def cost_fact(exact: bool = False) -> T.StructType:
    """``COST_FACT``, with amounts of exact sums where ``exact``."""
    return T.StructType([
        T.StructField(f.name, EXACT) if exact and f.name == "USD" else f for f in COST_FACT
    ])
