"""The experiment DAG (SRC-13): sources -> dimensions -> orders / sessions -> p-values.

``ExperimentDAG`` wires the operators into lazy DataFrames in dependency order
(the reference ran its scripts in directory-listing order, T1); a stage is only
built when something needs it.
``run_pipeline`` replaces every stage's named table (``plans.tables``) and reads
it by name for the next stage: each stage's lineage is cut at a durable table, a
lost executor only recomputes its own stage, a failed run leaves the tables of
the last one readable, and the dimensions are scanned from files whose size is
known when they are broadcast. With ``resume`` a stage whose fingerprint
(``plans.fingerprints``) is the published one is not even planned.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from armlens.config import ExperimentConfig, InferenceConfig
from armlens.operators import experiments as ex
from armlens.operators import inference as inf
from armlens.operators import orders as od
from armlens.operators import sessions as se
from armlens.plans.fingerprints import source_fingerprint, stage_fingerprint
from armlens.plans.materialize import cut_lineage
from armlens.plans.sizing import known_size
from armlens.plans.tables import TableStore


@dataclass
class Sources:
    entities: DataFrame
    experiment_setups: DataFrame
    vendors: DataFrame
    session_orders: DataFrame
    ab_test_orders: DataFrame
    shared_orders: DataFrame
    fee_override_orders: DataFrame
    countries: DataFrame
    ga_sessions: DataFrame

    @classmethod
    def from_world(cls, world) -> "Sources":
        return cls(**{f: getattr(world, f) for f in cls.__dataclass_fields__})

    @classmethod
    def from_tables(cls, spark: SparkSession, prefix: str = "", names: dict | None = None) -> "Sources":
        """The nine inputs as catalog tables: ``names`` (or ``<prefix><input>``) -> ``spark.table``."""
        return cls(**{f: spark.table((names or {}).get(f, prefix + f)) for f in cls.__dataclass_fields__})


DIMENSION_STAGES = ("setups", "entities", "valid_tests", "target_groups", "zones", "variants", "scheme_combos",
                    "zone_shapes")

# ORD-1: ORDER BY of the table-building statements, kept as file layout.
FILE_ORDER = {
    "target_groups": ("entity_id", "country_code", "test_start_date", "test_end_date", "test_name"),
    "zones": ("entity_id", "country_code"),
    "variants": ("entity_id", "country_code"),
}

# What a stage's rows depend on: sources, stages, parameters. Bounds of broadcasts change no row.
DEPENDS = {
    "setups": (("experiment_setups",), (), ()),
    "entities": (("entities", "session_orders"), (), ("excluded_entity_patterns", "excluded_entity_ids")),
    "valid_tests": ((), ("setups",), ("since", "name_patterns", "excluded_test_names")),
    "target_groups": (("vendors",), ("setups", "valid_tests"), ()),
    "zones": ((), ("setups", "valid_tests"), ()),
    "variants": ((), ("setups", "valid_tests"), ()),
    "scheme_combos": ((), ("variants",), ()),
    "zone_shapes": (("countries",), ("zones",), ()),
    "orders": (("session_orders", "ab_test_orders", "shared_orders", "fee_override_orders"),
               ("zone_shapes", "target_groups", "zones", "variants", "scheme_combos", "entities"),
               ("since", "fee_override_regions", "scheme_match", "keep_only")),
    "orders_cleaned": (("ab_test_orders",), ("orders", "target_groups"), ()),
    "session_events": (("ga_sessions", "vendors"), ("entities", "target_groups", "variants"), ("since",)),
    "session_flags": ((), ("session_events",), ()),
    "sessions_with_flag": ((), ("session_events", "session_flags", "valid_tests"), ()),
}

STAGE_ORDER = ("entities", "valid_tests", "target_groups", "zones", "variants", "scheme_combos", "zone_shapes",
               "orders", "orders_cleaned", "session_events", "session_flags", "sessions_with_flag")


class ExperimentDAG:
    """Every stage as a lazily built, memoised DataFrame. ``materialize(name,
    build) -> df`` may persist what ``build()`` returns and give the re-read
    table used downstream, or skip building what it has already."""

    def __init__(self, src: Sources, cfg: ExperimentConfig = ExperimentConfig(), materialize=None,
                 cut_dimensions: bool = True, profit_from_orders: bool = False):
        self.src, self.cfg = src, cfg
        # When the order table is itself materialised, the profit step reads it
        # (one shuffle of the enriched table) instead of re-running the star join.
        self.profit_from_orders = profit_from_orders
        if materialize is None:
            # Default: the small experiment dimensions become tables (as the
            # warehouse steps do); fact stages stay lazy.
            def materialize(name, build):
                return cut_lineage(build(), name) if cut_dimensions and name in DIMENSION_STAGES else build()
        self._m = materialize

    @cached_property
    def setups(self):
        """SRC-2 is read by four steps: one materialised copy."""
        return self._m("setups", lambda: self.src.experiment_setups)

    @cached_property
    def entities(self):
        return self._m("entities", lambda: ex.active_entities(self.src.entities, self.src.session_orders, self.cfg))

    @cached_property
    def valid_tests(self):
        return self._m("valid_tests", lambda: ex.select_experiments(self.setups, self.cfg))

    @cached_property
    def target_groups(self):
        return self._m("target_groups", lambda: ex.target_groups(self.setups, self.valid_tests,
                                                         self.src.vendors, self.cfg))

    @cached_property
    def zones(self):
        return self._m("zones", lambda: ex.experiment_zones(self.setups, self.valid_tests, self.cfg))

    @cached_property
    def variants(self):
        return self._m("variants", lambda: ex.variants_and_schemes(self.setups, self.valid_tests, self.cfg))

    @cached_property
    def scheme_combos(self):
        return self._m("scheme_combos", lambda: ex.scheme_combinations(self.variants))

    @cached_property
    def zone_shapes(self):
        return self._m("zone_shapes", lambda: ex.zone_shapes(self.src.countries, self.zones, self.cfg))

    @cached_property
    def orders(self):
        s = self.src
        return self._m("orders", lambda: od.enrich_orders(
            s.session_orders, s.ab_test_orders, s.shared_orders, s.fee_override_orders, self.zone_shapes,
            self.target_groups, self.zones, self.variants, self.scheme_combos, self.entities, self.cfg))

    @cached_property
    def orders_cleaned(self):
        s = self.src
        if self.profit_from_orders:
            return self._m("orders_cleaned", lambda: od.add_profit(self.orders, s.ab_test_orders, self.target_groups,
                                                           self.cfg))
        # DOM-8 + DOM-12/13 fused: same rows as add_profit(orders), one fact shuffle less.
        return self._m("orders_cleaned", lambda: od.enrich_orders(
            s.session_orders, s.ab_test_orders, s.shared_orders, s.fee_override_orders, self.zone_shapes,
            self.target_groups, self.zones, self.variants, self.scheme_combos, self.entities, self.cfg,
            with_profit=True))

    @cached_property
    def session_events(self):
        s = self.src
        return self._m("session_events", lambda: se.flatten_sessions(s.ga_sessions, s.vendors, self.entities,
                                                             self.target_groups, self.variants, self.cfg))

    @cached_property
    def session_table(self):
        """The flat events as a table: the flags and their join back read it."""
        flat = self.session_events
        return flat if known_size(flat) is not None else cut_lineage(flat, "session_events", as_table=True)

    @cached_property
    def session_flags(self):
        return self._m("session_flags", lambda: se.session_treatment_flags(self.session_table))

    @cached_property
    def sessions_with_flag(self):
        return self._m("sessions_with_flag", lambda: se.attach_session_flag(self.session_table, self.session_flags,
                                                                    self.valid_tests, self.cfg))


def pvalues(orders_cleaned: DataFrame, icfg: InferenceConfig = InferenceConfig()) -> DataFrame:
    return inf.experiment_pvalues(orders_cleaned, icfg)


class PipelineRun(dict):
    """Stage name -> table; ``rewritten``: the stages that ran, in order."""

    def __init__(self):
        super().__init__()
        self.rewritten: list[str] = []


def run_pipeline(spark: SparkSession, src: Sources, out_dir: str, cfg: ExperimentConfig = ExperimentConfig(),
                 icfg: InferenceConfig = InferenceConfig(), resume: bool = False, prefix: str = "",
                 source_versions: dict | None = None) -> PipelineRun:
    """Replace the table of every stage, and of the long p-values (SNK-3), under ``out_dir``; in the catalog
    they are named ``<prefix><stage>``. ``resume``: skip the stages whose parameters, upstream stages and
    source files are those of the published table. ``source_versions``: input -> a text that changes with it,
    e.g. a snapshot id, in place of a listing of its files."""
    store = TableStore(spark, out_dir, prefix)
    run = PipelineRun()
    prints: dict[str, str] = dict(source_versions or {})

    def fingerprint(name: str) -> str:
        """Of a stage or a source; each source is listed once."""
        if name not in prints:
            if name == "pvalues":
                prints[name] = stage_fingerprint(name, asdict(icfg), [fingerprint("stage orders_cleaned")])
            elif name.startswith("stage "):
                sources, stages, fields = DEPENDS[name[6:]]
                prints[name] = stage_fingerprint(name, {f: getattr(cfg, f) for f in fields},
                                                 [*map(fingerprint, sources), *(fingerprint(f"stage {s}") for s in stages)])
            else:
                prints[name] = source_fingerprint(getattr(src, name))
        return prints[name]

    def materialize(name: str, build) -> DataFrame:
        mark = fingerprint(name if name == "pvalues" else f"stage {name}") if resume else None
        done = store.current(name) if resume else None
        if done is not None and done.fingerprint == mark:
            return store.table(name)
        # ORD-1: the warehouse sorted some tables on write; only the file layout can observe it, so they are
        # sorted within partitions (no global sort).
        table = store.replace(build(), name, FILE_ORDER.get(name, ()), mark)
        run.rewritten.append(name)
        return table

    dag = ExperimentDAG(src, cfg, materialize, profit_from_orders=True)
    for name in STAGE_ORDER:
        run[name] = getattr(dag, name)
    run["pvalues"] = materialize("pvalues", lambda: pvalues(run["orders_cleaned"], icfg))
    return run
