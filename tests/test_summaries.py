"""Summaries against a brute-force evaluation of each group in Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rulefold import summarize
from rulefold.operators.summaries import FIRST_OPEN_OR_MODE, all_summaries, most_common
from tests.helpers import rows_of

TEXTS = [
    "finding_category", "sub_category", "rule_id", "fix_type", "fix_subtype", "fix_vendor_id",
    "rule_family", "rule_type", "finding_type", "source", "package_name", "fix_id", "image_id",
    "scan_id", "resource_reported_not_exist", "last_reported_time", "discovered_time",
    "created_time", "original_score", "original_status",
]
INTS = ["datasource_id", "datasource_definition_id", "system_status_key", "user_status_key", "severity"]
DOUBLES = ["score", "user_score", "normalized_score", "factorized_score"]
FLAGS = ["cisa_kev", "has_exploit"]
COLUMNS = ["g", "finding_id", "status_category", "main_resource_id", *TEXTS, *INTS, *DOUBLES, *FLAGS]
SCHEMA = ", ".join(
    ["g string", "finding_id long", "status_category string", "main_resource_id long"]
    + [f"{c} string" for c in TEXTS]
    + [f"{c} int" for c in INTS]
    + [f"{c} double" for c in DOUBLES]
    + [f"{c} boolean" for c in FLAGS]
)


def make_rows(seed=11):
    rng = random.Random(seed)
    rows = []
    for n in range(150):
        g = rng.choice(["a", "b", None, "closed", "void"])
        status = rng.choice(["FIXED", "IGNORED"]) if g == "closed" else rng.choice(["OPEN", "FIXED", "IGNORED"])
        void = g == "void"
        row = [g, n, status, rng.randrange(5)]
        row += [None if void or rng.random() < 0.4 else rng.choice("pqr") for _ in TEXTS]
        row += [None if void or rng.random() < 0.4 else rng.choice([9, 10, 11]) for _ in INTS]
        row += [None if void or rng.random() < 0.4 else float(rng.randrange(6)) for _ in DOUBLES]
        row += [None if void or rng.random() < 0.4 else rng.random() < 0.5 for _ in FLAGS]
        rows.append(dict(zip(COLUMNS, row)))
    return rows


def first_open(rows, f):
    return next((r[f] for r in sorted(rows, key=lambda r: r["finding_id"]) if r["status_category"] == "OPEN" and r[f] is not None), None)


def pick(fn, values):
    values = [v for v in values if v is not None]
    return fn(values) if values else None


def mode(values):
    counts = Counter(v for v in values if v is not None)
    return min(counts, key=lambda v: (-counts[v], v)) if counts else None


def first_of(*values):
    return next((v for v in values if v is not None), None)


def brute(rows):
    col = lambda f: [r[f] for r in rows]
    within = lambda s, f: [r[f] for r in rows if r["status_category"] == s]
    view = {"category": "finding_category", "finding_type_str": "finding_type"}
    out = {}
    for f in FIRST_OPEN_OR_MODE:
        v = view.get(f, f)
        out[f] = first_of(first_open(rows, v), mode(col(v)))
    out["package_name"] = mode(col("package_name"))
    out["fix_id"] = pick(max, col("fix_id"))
    for f in ("image_id", "scan_id", "resource_reported_not_exist"):
        values = {v for v in col(f) if v is not None}
        out[f] = values.pop() if len(values) == 1 else ""
    out["original_finding_id"] = ""
    for f, fn in (("last_reported_time", max), ("discovered_time", min), ("created_time", min), ("main_resource_id", min)):
        out[f] = first_of(pick(fn, within("OPEN", f)), pick(fn, col(f)))
    for s in ("OPEN", "FIXED", "IGNORED"):
        for k in ("system", "user"):
            out[f"{s.lower()}_{k}_status_key"] = pick(min, within(s, f"{k}_status_key"))
    out["min_closed_user_status"] = min(
        r["user_status_key"] if r["status_category"] != "OPEN" and r["user_status_key"] is not None else -1 for r in rows
    )
    out["min_open_user_status"] = pick(min, [-1 if v is None else v for v in within("OPEN", "user_status_key")])
    for f in ("score", "severity", "user_score", "normalized_score", "factorized_score"):
        out[f"max_open_{f}"] = pick(max, within("OPEN", f))
    out["max_score"], out["max_severity"] = pick(max, col("score")), pick(max, col("severity"))
    out["original_score"] = first_open(rows, "original_score")
    out["original_status"] = first_of(first_open(rows, "original_status"), "")
    for f in ("cisa_kev", "has_exploit"):
        out[f] = first_of(first_open(rows, f), pick(any, col(f)))
    out |= {"vulncheck_kev": False, "is_fixable": False, "vulnerability_reported_date": None}
    return out


@pytest.fixture(scope="module")
def data(spark):
    rows = make_rows()
    return rows, spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], SCHEMA)


def test_every_summary_equals_brute_force(data):
    rows, df = data
    got = {r["g"]: r.asDict() for r in summarize(df, ["g"]).collect()}
    groups = {g: [r for r in rows if r["g"] == g] for g in {r["g"] for r in rows}}
    assert set(got) == set(groups)
    for g, members in groups.items():
        want = brute(members)
        assert set(want) == set(got[g]) - {"g"}
        assert {k: got[g][k] for k in want} == want, g


def test_there_are_39_summaries_and_5_optional_ones(data):
    assert len(all_summaries(data[1])) == 44


def test_groups_by_a_column_that_is_also_a_summary(data):
    rows, df = data
    got = summarize(df, ["source"], only=["source", "max_score"])
    assert got.columns == ["group_source", "source", "max_score"]
    assert got.count() == len({r["source"] for r in rows})


def test_copies_count_in_the_most_common_value(spark):
    df = spark.createDataFrame([("g", "x", 1), ("g", "y", 5), ("g", "x", 1)], "g string, v string, row_copies long")
    assert rows_of(most_common(df, ["g"], {"best": "v"})) == [("g", "y")]


def test_ties_go_to_the_lowest_value_by_its_own_type(spark):
    df = spark.createDataFrame(
        [("g", "b", 10), ("g", "a", 9), ("h", None, None)], "g string, v string, n int"
    )
    got = most_common(df, ["g"], {"v": "v", "n": "n"})
    assert rows_of(got) == [("g", "a", 9), ("h", None, None)]
    assert dict(got.dtypes)["n"] == "int"


def test_optional_date_takes_the_earliest(spark):
    df = spark.sql(
        "SELECT 'g' AS g, 1L AS finding_id, 'OPEN' AS status_category, d AS vulnerability_reported_date"
        " FROM VALUES (DATE'2024-02-01'), (DATE'2023-01-05'), (NULL) AS t(d)"
    )
    got = summarize(df, ["g"], only=["vulnerability_reported_date"]).select(F.col("vulnerability_reported_date").cast("string"))
    assert rows_of(got) == [("2023-01-05",)]
