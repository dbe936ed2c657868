"""Published layers: one pointer for all tables, conditional commits, metrics that append once, contents by digest."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime

import pytest
from conftest import SMOKE, rows
from pyspark.sql import functions as F

from tesora.config import CHANGE_TRACKING, CLIENTES, SPECS, RunContext
from tesora.operators import audit
from tesora.plans import runner
from tesora.plans.catalogue import CFG, Lake
from tesora.sources import bronze, control, extract, sinks, snapshots


def numbers(spark, n):
    return {"silver.a": spark.range(n).selectExpr("id", "id * 2 AS b"), "silver.c": spark.range(n).selectExpr("cast(id AS string) AS c")}


def attempt(spark, cfg, name, frames):
    versions = runner.Versions(spark, cfg, RunContext(name, datetime(2024, 1, 1)), "silver")
    for full, df in frames.items():
        versions.write(df, *full.split("."))
    return versions


@pytest.fixture
def place(spark, tmp_path):
    cfg = replace(CFG, root=str(tmp_path), schema_prefix="snap_")
    sinks.ensure_namespaces(spark, cfg.root, cfg.schema_prefix)
    yield cfg
    for name in sinks.NAMESPACES:
        spark.sql(f"DROP DATABASE IF EXISTS snap_{name} CASCADE")


def held(spark):
    return spark.table("snap_silver.a").count(), spark.table("snap_silver.c").count()


def test_one_file_changes_all_tables(spark, place):
    attempt(spark, place, "R1", numbers(spark, 3)).publish()
    assert held(spark) == (3, 3)
    second = attempt(spark, place, "R2", numbers(spark, 5))
    assert held(spark) == (3, 3)  # written, not yet published
    entries = {name: (path, df.count(), "0") for name, (path, df) in second.written.items()}
    second.layer.commit(second.version, "R2", entries, second.after)  # the pointer alone; no view is touched
    assert held(spark) == (5, 5)
    plan = spark.table("snap_silver.a")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan and "Subquery" in plan  # other versions' files are pruned
    first = second.layer.newest(back=1)
    assert {name: df.count() for name, df in second.layer.read(first).items()} == {"silver.a": 3, "silver.c": 3}


def test_a_failure_between_two_tables_leaves_the_old_layer(spark, place):
    attempt(spark, place, "R1", numbers(spark, 3)).publish()
    broken = {**numbers(spark, 9), "silver.c": spark.range(9).select(F.raise_error(F.lit("bad row")).cast("string").alias("c"))}
    with pytest.raises(Exception, match="bad row"):
        attempt(spark, place, "R2", broken)
    assert held(spark) == (3, 3) and snapshots.Layer(spark, place.root, "silver").newest().run_id == "R1"


def test_only_one_of_two_runs_upon_a_snapshot_is_published(spark, place):
    attempt(spark, place, "R1", numbers(spark, 3)).publish()
    one, other = (attempt(spark, place, name, numbers(spark, n)) for name, n in (("R2", 4), ("R3", 6)))
    one.publish()
    with pytest.raises(sinks.PublishError, match="another run"):
        other.publish()
    assert held(spark) == (4, 4)
    assert [r.run_id for r in one.layer.commits().orderBy("seq").collect()] == ["R1", "R2"]


def test_a_table_may_change_its_columns(spark, place):
    attempt(spark, place, "R1", numbers(spark, 3)).publish()
    attempt(spark, place, "R 2/x", {**numbers(spark, 4), "silver.a": spark.range(4).selectExpr("id", "'n' AS b", "1 AS more")}).publish()
    assert spark.table("snap_silver.a").columns == ["id", "b", "more"] and held(spark) == (4, 4)
    attempt(spark, place, "R3", numbers(spark, 2)).publish()
    assert spark.table("snap_silver.a").columns == ["id", "b"] and held(spark) == (2, 2)


def test_a_torn_pointer_is_no_commit(spark, place):
    versions = attempt(spark, place, "R1", numbers(spark, 3))
    versions.publish()
    assert snapshots.create_once(spark, f"{versions.layer.folder}/{7:020d}.json", "")
    assert versions.layer.newest().run_id == "R1" and held(spark) == (3, 3)


def test_metrics_append_once_also_at_the_same_time(spark, tmp_path):
    root, columns = str(tmp_path), ("run_id", "table_name", "n")
    frames = [spark.createDataFrame([("R/1", t, i) for t in "ab"], "run_id string, table_name string, n long") for i in range(6)]
    with ThreadPoolExecutor(6) as pool:
        made = list(pool.map(lambda df: snapshots.append_once(df, root, "quality", "m", columns, "R/1", register=False), frames))
    stored = snapshots.appended(spark, root, "quality", "m", "run_id string, table_name string, n long").collect()
    assert sum(made) == 1 and len(stored) == 2 and {r.table_name for r in stored} == {"a", "b"} and len({r.n for r in stored}) == 1
    assert snapshots.append_once(frames[0].withColumn("run_id", F.lit("R2")), root, "quality", "m", columns, "R2", register=False)
    assert snapshots.appended(spark, root, "quality", "m", "run_id string, n long").count() == 4


def test_a_second_append_is_not_computed(spark, tmp_path):
    root, columns = str(tmp_path), ("run_id", "n")
    first = spark.createDataFrame([("R1", 1)], "run_id string, n long")
    assert snapshots.append_once(first, root, "quality", "m", columns, "R1", register=False)
    failing = first.withColumn("n", F.raise_error(F.lit("computed again")).cast("long"))
    assert not snapshots.append_once(failing, root, "quality", "m", columns, "R1", register=False)
    assert snapshots.appended(spark, root, "quality", "m", "run_id string, n long").collect()[0].n == 1


def test_claims_are_never_shared(spark, tmp_path):
    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(lambda _: snapshots.claim(spark, str(tmp_path), 1), range(12)))
    assert sorted(found) == list(range(1, 13))


def test_contents_show_one_cell_and_no_order(spark):
    df = spark.range(500).selectExpr("id", "cast(id % 7 AS decimal(18,2)) AS v", "if(id = 3, null, 'x') AS t", "current_timestamp() AS _stamp")
    state = lambda d: {r.table_name: (r["rows"], r.digest) for r in audit.contents({"t": d, "none": d.limit(0)}).collect()}
    first = state(df)
    assert first["none"] == (0, "0")
    audit.assert_same_contents(first, state(df.repartition(7).select("t", "_stamp", "v", "id")))
    cell = df.withColumn("v", F.when(F.col("id") == 499, F.col("v") + F.lit("0.01").cast("decimal(18,2)")).otherwise(F.col("v")).cast("decimal(18,2)"))
    for changed in (cell, df.where("id > 0"), df.union(df.limit(1)), df.withColumn("t", F.coalesce("t", F.lit("")))):
        assert audit.altered(first, state(changed)) == ["t"]
        with pytest.raises(audit.AuditError, match="contents differ: t"):
            audit.assert_same_contents(first, state(changed))


def test_a_success_is_one_step_and_no_kept_configuration_turns_it_back(spark, tmp_path, monkeypatch):
    cfg = replace(CFG, root=str(tmp_path), specs={CLIENTES: SPECS[CLIENTES]})
    source = Lake(spark, SMOKE).owned(CLIENTES)
    spec = SPECS[CLIENTES]
    assert spec.strategy == CHANGE_TRACKING
    config = spark.createDataFrame([("dbo", CLIENTES.upper(), spec.strategy, spec.key, None, None, None, False, True, datetime(2024, 1, 1))], control.CONFIG_SCHEMA)
    changed = source.agg(F.min("id_cli")).first()[0]

    def run(name, version):
        feed = extract.ChangeFeed(spark.createDataFrame([(changed, 2, "U")], f"{spec.key} {spec.types[spec.key]}, version bigint, op string"), version, 1)
        return runner.run_bronze(spark, {CLIENTES: lambda: source}, config, cfg, RunContext(name, datetime(2024, 1, 2)), {CLIENTES: feed}, register=False)

    def landed():
        return bronze.read_bronze(spark, f"{cfg.root}/bronze", spec).count()

    whole = source.count()
    append = sinks.append_rows

    def crash(df, *args, **kwargs):
        if "status" in df.columns and not df.where("status = 'SUCCEEDED'").isEmpty():
            raise OSError("lost")
        append(df, *args, **kwargs)

    monkeypatch.setattr(sinks, "append_rows", crash)
    with pytest.raises(OSError, match="lost"):  # landed, not logged
        run("R1", 1)
    monkeypatch.setattr(sinks, "append_rows", append)
    assert landed() == whole
    run("R1", 1)  # nothing says that it succeeded, so all comes again
    assert landed() == 2 * whole
    again = run("R2", 2)  # the first configuration once more: only the change since version 1
    assert landed() == 2 * whole + 1
    state = again.config.first()
    assert state["initial_load_completed"] and state["last_change_version"] == 2
    assert run("R3", 2).log.where("rows_copied > 0").isEmpty()
    assert rows(control.progress(config, again.log), "last_change_version") == [(2,)]
