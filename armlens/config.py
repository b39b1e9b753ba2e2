"""Parameters of the experiment pipeline (everything the SQL hard-codes)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ExperimentConfig:
    # Fixed values of the experiment definition: patterns, excluded names and ids, regions.
    # DOM-2: tests that started on/after this date and whose lower-cased name
    # matches one of the LIKE patterns, minus explicitly excluded names.
    since: str = "2022-11-28"
    name_patterns: tuple = ("%loved_brands%", "%love_brands%", "%lb%", "%lovedbrands%", "%lovebrands%")
    excluded_test_names: tuple = ("DK_20221213_R_B0_O_Aalborg",)
    # DOM-1: entity exclusions (LIKE patterns, where '_' is a one-char wildcard).
    excluded_entity_patterns: tuple = ("ODR%", "DN_%")
    excluded_entity_ids: tuple = ("FP_DE", "FP_JP", "TB_SA", "HS_BH")
    # DOM-10: regions whose fee comes from the override table when present.
    fee_override_regions: tuple = ("Europe", "Asia")
    # DOM-11: how an order's "TG | variant | scheme" is matched against the
    # test's combination list: "substring" (LIKE, as the SQL does) or "exact".
    scheme_match: str = "substring"
    # T15: keep only the orders whose flag column of this name is 'Keep'; None: flags only, as the SQL does.
    keep_only: str | None = None
    # Broadcast bound for experiment dimensions (rows); beyond it: shuffle join.
    broadcast_max_rows: int = 2_000_000


@dataclass(frozen=True)
class InferenceConfig:
    # Names of the KPI columns.
    # DOM-20: KPI columns summed per day, plus the distinct order count.
    kpis: tuple = (
        "actual_df_paid_by_customer", "dps_travel_time_fee_local", "gfv_local", "gmv_local",
        "commission_local", "revenue_local", "delivery_costs_local", "gross_profit_local",
    )
    count_kpi: str = "order_count"
    order_id_col: str = "order_id"
    date_col: str = "created_date_utc"
    # group keys of the daily series, in the order that defines positions (T12)
    keys: tuple = ("region", "entity_id", "test_id", "test_name")
    variant_col: str = "variant"
    control: str = "Control"
    scope_col: str = "is_in_treatment"
    segment_col: str = "target_group_bi"
    # DOM-22 statistics options
    pair_on: str = "position"       # "position" (reference) or "date"
    ties_exact: bool = False        # exact p-value also when |d| has ties
    exact_max_n: int = 50
    granularity_base: tuple = field(default=("Experiment", "Treatment Scope", "Non-Treatment Scope"))
