"""Documents of any shape in one scan."""

from __future__ import annotations

import json

from goldrow.session import scratch_path
from goldrow.sources import readers

DOCUMENTS = [
    [{"id": 1, "a b": "x"}, {"id": 2}],
    {"data": [{"id": 3, "n": {"k": None}}], "other": 1},
    {"data": None, "id": 4},
    {"data": [1, 2], "id": 5},
    {"data": [], "id": 6},
    [],
    {"id": 7, "it's": "quoted", "back\\slash": 1.5},
]


def test_shapes(spark):
    for per_line in (True, False):
        path = scratch_path(spark, "shapes")
        texts = [json.dumps(d) for d in DOCUMENTS] + ["{broken"]
        rows = spark.createDataFrame([(t,) for t in texts], "value string")
        rows.repartition(len(texts) if per_line else 1).write.text(path)
        if not per_line:
            rows = spark.createDataFrame([(t,) for t in texts[:1]], "value string")
            rows.coalesce(1).write.mode("overwrite").text(path)
        records = readers.read_records(spark, path, per_line)
        plan = records._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan text") == 1
        names = ["id", "a b", "n", "data", "it's", "back\\slash"]
        got = sorted((tuple(r)[1:] for r in readers.record_text(records, names).collect()), key=repr)
        first = [(0, "1", "x", None, None, None, None), (1, "2", None, None, None, None, None)]
        if not per_line:
            assert got == first
            continue
        assert got == sorted(
            [
                *first,
                (0, "3", None, '{"k":null}', None, None, None),
                (0, "4", None, None, None, None, None),
                (0, "5", None, None, "[1,2]", None, None),
                (0, "6", None, None, "[]", None, None),
                (0, "7", None, None, None, "quoted", "1.5"),
                (0, None, None, None, None, None, None),
            ],
            key=repr,
        )
