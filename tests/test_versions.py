"""Versions of several tables: all of one run or of the one before."""

import pytest

from rulefold import Rule, group_findings
from rulefold.plans.runs import publish_version
from rulefold.schemas import ASSOCIATION_TABLE, ROLLUP_TABLE
from rulefold.sources.versions import StaleRun, VersionedTables


@pytest.fixture
def store(spark, tmp_path):
    return VersionedTables(spark, f"file://{tmp_path}/published")


def numbers(spark, n):
    return spark.range(n)


def published(store, *sizes):
    draft = store.begin()
    for name, n in zip(("one", "two"), sizes, strict=True):
        draft.write(name, store.spark.range(n))
    return store.commit(draft, {"sizes": list(sizes)})


def test_readers_see_the_last_commit_only(spark, store):
    assert store.current() is None and store.numbers() == []
    with pytest.raises(LookupError):
        store.read("one")
    assert published(store, 3, 4).number == 1
    failed = store.begin()
    failed.write("one", spark.range(99))
    assert {n: df.count() for n, df in store.read("one", "two").items()} == {"one": 3, "two": 4}
    assert published(store, 5, 6).number == 2
    assert {n: df.count() for n, df in store.read("one", "two").items()} == {"one": 5, "two": 6}
    assert {n: df.count() for n, df in store.read("one", "two", number=1).items()} == {"one": 3, "two": 4}
    assert store.current().facts == {"sizes": [5, 6]}
    with pytest.raises(LookupError):
        store.read("one", number=7)


def test_a_run_from_an_older_version_is_refused(spark, store):
    published(store, 1, 1)
    late = store.begin()
    late.write("one", spark.range(9))
    published(store, 2, 2)
    with pytest.raises(StaleRun):
        store.commit(late)
    assert store.current().number == 2 and store.read("one")["one"].count() == 2


def test_of_two_commits_at_once_one_wins(store, monkeypatch):
    first, second = store.begin(), store.begin()
    store.commit(first)
    monkeypatch.setattr(store, "current", lambda: None)  # as if it had looked just before
    with pytest.raises(StaleRun):
        store.commit(second)


def test_a_commit_that_broke_off_is_passed_over(spark, store):
    published(store, 1, 2)
    store._files().create(store._path("_versions", f"{2:012d}"), False).close()  # no content
    assert store.current().number == 1 and store.numbers() == [1, 2]
    assert published(store, 3, 4).number == 3 and store.read("one")["one"].count() == 3


def test_old_data_expires(store):
    for n in range(1, 5):
        published(store, n, n)
    running = store.begin()
    running.write("one", store.spark.range(1))
    assert store.expire(keep=2) == [1, 2]
    assert store.read("one", number=3)["one"].count() == 3 and store.begin().number == 5
    store.commit(running)


def test_both_outputs_of_a_grouping(spark, store):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "finding_id long, package_name string, cloud_account string")
    publish_version(store, group_findings(df, [Rule(1, 1, ("package_name",))], unique_ids=True))
    tables = store.read(ASSOCIATION_TABLE, ROLLUP_TABLE)
    assert tables[ASSOCIATION_TABLE].count() == tables[ROLLUP_TABLE].count() == 2
