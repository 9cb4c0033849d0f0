"""Which tables are sent to the driver and from there to all executors."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from docmonitor.operators import files as J
from docmonitor.session import configure
from docmonitor.sources import state as store

SITE = "https://a.fr/"
PLANNED_BROADCAST, MEASURED_BROADCAST = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


@pytest.fixture
def session(spark):
    session = spark.newSession()
    for name in (PLANNED_BROADCAST, MEASURED_BROADCAST):
        session.conf.unset(name)
    return session


def seen_of(session, root, n):
    """State of ``n`` files in few bytes, and the files: these and one more."""
    keys = session.range(n).select(F.concat(F.lit(SITE + "a" * 200), "id", F.lit(".pdf")).alias("key"))
    blank = F.lit("x").alias
    rows = keys.select(F.lit("documents").alias("kind"), "key", *map(blank, ("last_modified", "last_seen", "target_year")))
    store.write_seen(rows, root, 0)
    store.commit_batch(session, root, 0, "r", dt.datetime(2024, 1, 1), n)
    files = session.range(n + 1).select(F.concat(F.lit(SITE + "a" * 200), "id", F.lit(".pdf")).alias("source_file_url"))
    return store.read_seen(session, root), files


def anti_joins(df):
    return {*re.findall(r"(\w+Join) .*LeftAnti", df._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0])}


def test_a_state_in_few_bytes_is_not_broadcast(session, tmp_path):
    seen, files = seen_of(configure(session), str(tmp_path), 100_000)  # some 20 MB of keys
    bytes_ = sum(p.stat().st_size for p in (tmp_path / "seen").rglob("*.parquet"))
    assert bytes_ < 10 << 20
    new = J.not_seen_final(files, seen)
    assert [r.source_file_url for r in new.collect()] == [f"{SITE}{'a' * 200}100000.pdf"]
    assert anti_joins(new) == {"SortMergeJoin"}


def test_a_small_state_is_broadcast_once_it_is_measured(session, tmp_path):
    seen, files = seen_of(configure(session), str(tmp_path), 10)
    new = J.not_seen_final(files, seen)
    assert anti_joins(new) == {"SortMergeJoin"}  # not known yet
    assert [r.source_file_url for r in new.collect()] == [f"{SITE}{'a' * 200}10.pdf"]
    assert anti_joins(new) == {"BroadcastHashJoin"}


def test_runs_shuffle_no_state(session, tmp_path):
    seen, _ = seen_of(configure(session), str(tmp_path), 10)
    for rows in (seen, store.read_seen_as_of(session, str(tmp_path), dt.datetime(2024, 1, 1))):
        assert rows.count() == 10
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert not re.search("LeftSemi", "\n".join(x for x in plan.splitlines() if "SortMergeJoin" in x))


@pytest.mark.parametrize("bound, measured, want", [
    ("256k", None, "256k"), ("256k", "1m", "1m"), ("-1", None, None), ("-1", "1m", "1m")])
def test_the_bound_of_the_session_stays(session, bound, measured, want):
    session.conf.set(PLANNED_BROADCAST, bound)
    if measured:
        session.conf.set(MEASURED_BROADCAST, measured)
    for _ in range(2):
        configure(session)
        assert session.conf.get(PLANNED_BROADCAST) == "-1"
        assert session.conf.get(MEASURED_BROADCAST, None) == want
