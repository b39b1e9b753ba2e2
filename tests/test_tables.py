"""SNK-1..3, SRC-10, SRC-11, SRC-13: named tables and resumed runs."""
import tempfile
import uuid
from dataclasses import replace as changed

import pytest
from pyspark.sql import functions as F

from armlens.config import ExperimentConfig, InferenceConfig
from armlens.plans import pipeline as P
from armlens.plans.fingerprints import source_fingerprint
from armlens.plans.sizing import known_size
from armlens.plans.tables import TableStore
from armlens.sources import adapters as A

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def store(spark):
    return TableStore(spark, tempfile.mkdtemp(prefix="armlens-tables-"), prefix=f"t{uuid.uuid4().hex[:8]}_")


def values(spark, store, name="t"):
    return sorted(r[0] for r in spark.table(store.prefix + name).collect())


def test_replace_changes_rows_and_schema_at_once(spark, store):
    store.replace(spark.range(3), "t")
    before = store.table("t")
    assert known_size(before).rows == 3 and values(spark, store) == [0, 1, 2]
    store.replace(spark.range(2).selectExpr("concat('v', id) as name", "id"), "t")
    assert values(spark, store) == ["v0", "v1"] and spark.table(store.prefix + "t").columns == ["name", "id"]
    assert sorted(r[0] for r in before.collect()) == [0, 1, 2]  # a reader of the old version goes on
    assert len(store.superseded()) == 1 and store.history().count() == 2
    other = TableStore(spark, store.root, prefix=store.prefix)  # a second store, then the first one again
    other.replace(spark.range(9), "t")
    store.replace(spark.range(4), "t")
    assert TableStore(spark, store.root, prefix=store.prefix + "x_").table("t").count() == 4


def test_a_failed_replace_leaves_the_old_table(spark, store):
    store.replace(spark.range(5), "t")
    bad = spark.range(100, 200, 1, 4).select(F.when(F.col("id") == 177, F.raise_error(F.lit("midway"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="midway"):
        store.replace(bad, "t")
    assert values(spark, store) == [0, 1, 2, 3, 4]
    fresh = TableStore(spark, store.root, prefix=store.prefix + "again_")  # what another session sees
    assert fresh.attach() == [fresh.prefix + "t"] and values(spark, fresh) == [0, 1, 2, 3, 4]


def test_replace_while_reading(spark, store):
    store.replace(spark.range(10), "t")
    for _ in range(2):
        store.replace(store.table("t").where("id % 2 = 0").selectExpr("id div 2 as id"), "t")
    assert values(spark, store) == [0, 1, 2]


def test_truncate_and_load_keeps_the_columns(spark, store):
    with pytest.raises(KeyError):
        store.truncate_and_load(spark.range(1), "t")
    store.replace(spark.range(3), "t")
    store.truncate_and_load(spark.range(7, 9), "t")
    assert values(spark, store) == [7, 8]
    with pytest.raises(ValueError):
        store.truncate_and_load(spark.range(2).selectExpr("cast(id as int) as id"), "t")
    with pytest.raises(KeyError):
        store.table("unknown")
    assert values(spark, store) == [7, 8]


def test_empty_tables(spark, store):
    store.replace(spark.range(0), "t")
    assert values(spark, store) == [] and known_size(store.table("t")).rows == 0


def test_source_fingerprint_follows_the_files(spark):
    path = tempfile.mkdtemp(prefix="armlens-source-") + "/t 1"
    spark.range(10).write.parquet(path)
    one = source_fingerprint(spark.read.parquet(path).where("id > 3"))
    assert one == source_fingerprint(spark.read.parquet(path).where("id > 3"))
    spark.range(11).write.mode("append").parquet(path)
    assert one != source_fingerprint(spark.read.parquet(path).where("id > 3"))
    assert source_fingerprint(spark.range(3)) != source_fingerprint(spark.range(3))


def test_a_changed_parameter_rewrites_only_what_depends_on_it(spark, store):
    from armlens.plans.queries import WORLD_CFG, world
    src = P.Sources.from_world(world(spark, SF))
    run = lambda cfg=WORLD_CFG, icfg=InferenceConfig(): P.run_pipeline(
        spark, src, store.root, cfg, icfg, resume=True, prefix=store.prefix)
    first = run()
    assert set(first.rewritten) == {*P.DEPENDS, "pvalues"}
    before = {n: store.refresh()[n].version for n in first.rewritten}
    assert run().rewritten == []
    fees = run(changed(WORLD_CFG, fee_override_regions=("Europe",)))
    assert fees.rewritten == ["orders", "orders_cleaned", "pvalues"]
    assert run(changed(WORLD_CFG, broadcast_max_rows=7, fee_override_regions=("Europe",))).rewritten == []
    assert run(changed(WORLD_CFG, fee_override_regions=("Europe",)), InferenceConfig(pair_on="date")).rewritten == ["pvalues"]
    after = {n: store.refresh()[n].version for n in first.rewritten}
    assert {n for n in before if before[n] != after[n]} == {"orders", "orders_cleaned", "pvalues"}
    # a run that breaks off midway is taken up where it stopped
    dropped = changed(WORLD_CFG, excluded_entity_ids=("E1",))

    def broken(*a, **k):
        raise RuntimeError("midway")
    keep, P.od.add_profit = P.od.add_profit, broken
    try:
        with pytest.raises(RuntimeError, match="midway"):
            run(dropped)
    finally:
        P.od.add_profit = keep
    assert spark.table(store.prefix + "orders_cleaned").count() == fees["orders_cleaned"].count()
    assert run(dropped).rewritten == ["orders_cleaned", "session_events", "session_flags", "sessions_with_flag", "pvalues"]


def test_sources_by_table_name(spark, store):
    from armlens.plans.queries import world
    w = world(spark, SF)
    for name in P.Sources.__dataclass_fields__:
        store.replace(getattr(w, name), name)
    src = P.Sources.from_tables(spark, store.prefix)
    cfg = ExperimentConfig(since=A.SINCE, excluded_test_names=(A.EXCLUDED_TEST,))
    mine = P.ExperimentDAG(src, cfg).target_groups
    other = P.ExperimentDAG(P.Sources.from_world(w), cfg).target_groups
    assert sorted(map(str, mine.collect())) == sorted(map(str, other.collect())) and mine.count() > 0
    named = P.Sources.from_tables(spark, "nowhere_", {f: store.prefix + f for f in P.Sources.__dataclass_fields__})
    assert named.vendors.count() == w.vendors.count()


def test_every_stage_has_its_dependencies():
    assert set(P.STAGE_ORDER) <= set(P.DEPENDS)
    for sources, stages, fields in P.DEPENDS.values():
        assert set(sources) <= set(P.Sources.__dataclass_fields__) and set(stages) <= set(P.DEPENDS)
        assert set(fields) <= set(ExperimentConfig.__dataclass_fields__)
