"""Every registered query against its DuckDB statement, over the smallest tables."""

import duckdb
import pytest

from cairnflow.plans import ingest_plans, queue_plans, registry, registry_plans  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def shown(v):
    return "~" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    rows = sorted(tuple(map(shown, r)) for r in df.select(*columns).collect())
    if name not in registry.ORACLE_SQL:
        assert rows
        return
    got = duck.execute(registry.ORACLE_SQL[name])
    names = [c[0] for c in got.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows == sorted(tuple(shown(r[i]) for i in at) for r in got.fetchall())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_are_the_ones_wanted(spark, sf):
    claim = plan_of(registry.QUERIES["queue_claim"](spark, sf))
    assert "TakeOrderedAndProject" in claim and "LeftAnti" in claim
    for name in ("fsck_report", "outcomes_applied", "snapshot_diff", "campaign_apply", "shard_build"):
        plan = plan_of(registry.QUERIES[name](spark, sf))
        assert "CartesianProduct" not in plan and "Python" not in plan, name
    census = plan_of(registry.QUERIES["pending_backlog"](spark, sf))
    assert "text" not in census.split("ReadSchema")[1]


ALL_ROWS = {"bridge_lookup": ("documents", "doc_id"), "yanked_parse": ("events", "event_id"), "metadata_hash_resolve": ("events", "event_id"), "index_page_parse": ("part", "p_partkey"), "resolution_dedup": ("events", "user_id")}


@pytest.mark.parametrize("name", sorted(ALL_ROWS))
def test_every_key_has_a_row(spark, sf, duck, name):
    table, key = ALL_ROWS[name]
    assert registry.QUERIES[name](spark, sf).count() == duck.execute(f"SELECT count(DISTINCT {key}) FROM {table}").fetchone()[0]


def test_all_artifacts_are_counted_and_read(spark, sf, duck):
    n, texts = duck.execute("SELECT count(*), count(DISTINCT text) FROM documents").fetchone()
    assert sum(r.n for r in registry.QUERIES["state_census"](spark, sf).collect()) == n
    assert registry.QUERIES["initial_state"](spark, sf).count() == registry.QUERIES["project_gone"](spark, sf).count() == n
    assert registry.QUERIES["blob_read"](spark, sf).count() == texts + 1


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("name", ["apply_plan_sequence", "sequence_behind_last"])
def test_sequences_over_many_partitions_are_those_of_sql(spark, tmp_path, name, adaptive):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT range AS doc_id, 'text' AS text, 'en' AS lang, 'src' || (range % 40) AS source, range % 1000 AS n_chars FROM range(60000)")
    con.execute("CREATE TABLE labels AS SELECT doc_id, 1 AS quality, 0 AS toxic FROM documents WHERE doc_id % 5 < 2")
    for t in ("documents", "labels"):
        con.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
    settings = {"spark.sql.adaptive.enabled": adaptive, "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = registry.QUERIES[name](spark, str(tmp_path))
        got = sorted(map(tuple, df.collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == sorted(con.execute(f"SELECT {', '.join(df.columns)} FROM ({registry.ORACLE_SQL[name]})").fetchall())
