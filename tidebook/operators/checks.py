"""Quality gates as rows.

Each function turns one frame into check rows with one aggregation, however
many rules it covers. ``enforce`` raises the failed gate with the lowest ``ord``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidebook.functions import blank
from tidebook.operators.report import final_balance, net_column
from tidebook.operators.reconcile import NET_CHANGE
from tidebook.plans.lines import SECTIONS, LineBook
from tidebook.plans.scenario import Scenario
from tidebook.sources.extract import UNKNOWN_ENTITY


class GateFailure(Exception):
    """A gate failed; nothing may be published."""

    def __init__(self, check_id: str, message: str):
        super().__init__(f"{check_id}: {message}")
        self.check_id = check_id


@dataclass(frozen=True)
class Gate:
    """``notice`` gates count, but never fail."""

    stage: str
    check_id: str
    ord: int
    notice: bool = False

    def row(
        self, violations: str, observed: str | None = None, expected: str = "0", sample: str = "NULL"
    ) -> str:
        """A struct of the check columns; the arguments are expressions over an aggregate."""
        count = f"CAST(coalesce({violations}, 0) AS BIGINT)"
        return (
            f"struct('{self.stage}' AS stage, '{self.check_id}' AS check_id, {self.ord} AS ord, "
            f"{count} AS violations, CAST({observed or count} AS STRING) AS observed, "
            f"CAST({expected} AS STRING) AS expected, CAST({sample} AS STRING) AS sample_key, "
            f"{'true' if self.notice else f'{count} = 0'} AS passed)"
        )


def _rows(aggregated: DataFrame, *rows: str) -> DataFrame:
    return aggregated.selectExpr(f"inline(array({', '.join(rows)}))")


def combine(*parts: DataFrame) -> DataFrame:
    """Union of all parts, halves first, so no union stacks on a long chain."""
    if len(parts) == 1:
        return parts[0]
    middle = len(parts) // 2
    return combine(*parts[:middle]).unionByName(combine(*parts[middle:]))


def enforce(checks: DataFrame) -> None:
    """Raise for the first failed gate. The frame holds one row per gate."""
    failed = checks.filter(~F.col("passed")).orderBy("ord", "check_id").take(1)
    if failed:
        row = failed[0]
        raise GateFailure(
            row["check_id"],
            f"{row['violations']} violations, observed {row['observed']}, "
            f"expected {row['expected']}, e.g. {row['sample_key']}",
        )


# --- scenario, feeds and amounts ---------------------------------------------

SCENARIO_GATES = (
    ("scenario_rows", 1, "n <> 1", "n", "1"),
    ("scenario_complete", 2, "n - complete", "complete", "n"),
    ("scenario_months", 3, "bad_months", "coalesce(worst_months, CAST(bad_months AS STRING))", "'1..12 closed, 1 or more open'"),
    ("scenario_name", 4, "bad_names", "coalesce(some_name, CAST(bad_names AS STRING))", "coalesce(wanted_name, 'as its months')"),
)


def scenario_checks(table: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """The rules of a scenario table as gate rows, whatever it holds.

    Exactly one row, no empty field, months in range, a name that says the months. With
    ``groups`` (their columns are in the table too) each group is a scenario table of its
    own, and one without rows is judged as well.
    """
    by = groups.columns if groups is not None else []
    name = F.trim(F.col("scenario"))
    wanted = F.concat(F.col("actual_months").cast("string"), F.lit("+"), F.col("forecast_months").cast("string"))
    complete = name.isNotNull() & F.col("fiscal_year").isNotNull() & wanted.isNotNull()
    usable = F.col("actual_months").between(1, 12) & (F.col("forecast_months") >= 1)
    rows = table.select(
        *by,
        F.lit(1).alias("one"),
        complete.cast("int").alias("is_complete"),
        F.when(~usable, wanted).alias("months"),
        F.when(name != wanted, name).alias("name"),
        F.when(name != wanted, wanted).alias("wanted"),
    )
    if groups is not None:
        rows = rows.unionByName(groups.distinct(), allowMissingColumns=True)
    found = rows.groupBy(*by).agg(
        F.count("one").alias("n"),
        F.coalesce(F.sum("is_complete"), F.lit(0)).alias("complete"),
        F.count("months").alias("bad_months"),
        F.min("months").alias("worst_months"),
        F.count("name").alias("bad_names"),
        F.min("name").alias("some_name"),
        F.min("wanted").alias("wanted_name"),
    )
    gates = [
        Gate("scenario", check_id, place).row(f"CAST({violations} AS INT)", observed, expected, observed)
        for check_id, place, violations, observed, expected in SCENARIO_GATES
    ]
    return found.selectExpr(*by, f"inline(array({', '.join(gates)}))")


def reject_checks(rejects: DataFrame, allowed: int = 0) -> DataFrame:
    """Records that could not be read; more than ``allowed`` fail the run."""
    found = rejects.groupBy("feed", "record_id").agg(F.count("*").alias("n")).agg(
        F.count("*").alias("n"),
        F.min(F.concat_ws("/", "feed", F.coalesce("record_id", F.lit("no id")))).alias("sample"),
    )
    gate = Gate("read", "unreadable_records", 3)
    return _rows(found, gate.row(f"greatest(n - {allowed}, 0)", "n", str(allowed), "sample"))


AMOUNT_OUTCOMES = ("no price", "one factor missing", "differs", "agrees")


def amount_identity(priced: DataFrame, tolerance_cents: int = 0) -> DataFrame:
    """Each record's amount beside the product of its quantity and unit price.

    The product is exact, and rounded to cents, halves up, before it is compared. A
    record with neither factor is no subject of the rule; one with one of them breaks it.
    """
    quantity, price, amount = F.col("quantity"), F.col("unit_price"), F.col("amount")
    product = F.round(quantity * price, 2).cast("decimal(38,2)")
    off = ((amount - product) * 100).cast("decimal(38,0)")
    outcome = (
        F.when(quantity.isNull() & price.isNull(), "no price")
        .when(quantity.isNull() | price.isNull(), "one factor missing")
        .when(F.coalesce(F.abs(off) > tolerance_cents, F.lit(True)), "differs")
        .otherwise("agrees")
    )
    return priced.withColumn("product", product).withColumn("off_cents", off).withColumn("outcome", outcome)


def amount_checks_by_record(priced: DataFrame, tolerance_cents: int = 0) -> DataFrame:
    wrong = F.col("outcome").isin("one factor missing", "differs")
    found = amount_identity(priced, tolerance_cents).agg(
        F.count_if(wrong).alias("n"),
        F.sum(F.when(wrong, F.abs("off_cents"))).alias("off"),
        F.min(F.when(wrong, F.col("transaction_id"))).alias("sample"),
    )
    return _rows(found, Gate("close", "amount_is_product", 45).row("n", sample="sample"))


# --- mapping and ledger ------------------------------------------------------


def repeated_rules(rules: DataFrame) -> DataFrame:
    """Mapping keys with more than one rule; each would duplicate its transactions."""
    return rules.groupBy("source", "category").count().filter("count > 1")


def mapping_checks(rules: DataFrame) -> DataFrame:
    found = repeated_rules(rules).agg(
        F.count("*").alias("n"),
        F.min(F.concat_ws("/", "source", "category")).alias("sample"),
    )
    return _rows(
        found, Gate("close", "repeated_mapping_key", 5).row("n", sample="sample")
    )


def repeated_dimension_keys(dimensions: dict[str, DataFrame]) -> DataFrame:
    """Rows, keys and repeated keys of each dimension; a repeated key multiplies events."""
    keys = [
        frame.select(F.lit(name).alias("dimension"), "dimension_key") for name, frame in dimensions.items()
    ]
    per_key = combine(*keys).groupBy("dimension", "dimension_key").agg(F.count("*").alias("n"))
    return per_key.groupBy("dimension").agg(
        F.sum("n").alias("n_rows"),
        F.count("dimension_key").alias("n_keys"),
        F.count_if(F.col("dimension_key").isNotNull() & (F.col("n") > 1)).alias("repeated_keys"),
        F.min(F.when(F.col("n") > 1, F.col("dimension_key").cast("string"))).alias("sample_key"),
    )


def dimension_checks(dimensions: dict[str, DataFrame]) -> DataFrame:
    found = repeated_dimension_keys(dimensions).agg(
        F.sum("repeated_keys").alias("n"),
        F.min(F.when(F.col("repeated_keys") > 0, F.concat_ws("/", "dimension", "sample_key"))).alias("sample"),
    )
    return _rows(found, Gate("close", "repeated_dimension_key", 7).row("n", sample="sample"))


def unmapped_categories(ledger: DataFrame) -> DataFrame:
    return (
        ledger.filter(F.col("reporting_line").isNull())
        .groupBy("source", "source_category")
        .agg(F.count("*").alias("n_records"))
    )


def repeated_ids(ids: DataFrame, *keys: str) -> DataFrame:
    """Ids that occur more than once; equal ids collapse before the shuffle."""
    return ids.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def missing_vendor(vendor_sources: tuple[str, ...]) -> Column:
    return F.col("source").isin(*vendor_sources) & blank(F.col("vendor"))


def ledger_checks(
    ledger: DataFrame,
    scenario: Scenario,
    vendor_sources: tuple[str, ...],
    strict_window: bool = True,
) -> DataFrame:
    """All row rules of the mapped ledger in one pass, sharing the shuffle on the id."""

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    inside = F.coalesce(scenario.closed(F.col("cash_date")), F.lit(False))
    per_id = ledger.groupBy("transaction_id").agg(
        F.count("*").alias("n_rows"),
        rows_where(F.col("reporting_line").isNull()).alias("unmapped"),
        rows_where(missing_vendor(vendor_sources)).alias("no_vendor"),
        rows_where(~inside).alias("outside"),
        rows_where(F.col("entity_id") == UNKNOWN_ENTITY).alias("no_entity"),
    )
    no_id = blank(F.col("transaction_id"))
    repeated = (F.col("n_rows") > 1) & ~no_id
    found = per_id.agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("unmapped").alias("unmapped"),
        F.sum("no_vendor").alias("no_vendor"),
        F.sum("outside").alias("outside"),
        F.sum("no_entity").alias("no_entity"),
        F.sum(F.when(no_id, F.col("n_rows")).when(repeated, 1).otherwise(0)).alias("bad_ids"),
        *[
            F.min(F.when(F.col(c) > 0, F.col("transaction_id"))).alias(f"{c}_sample")
            for c in ("unmapped", "no_vendor", "outside", "no_entity")
        ],
        F.min(F.when(repeated, F.col("transaction_id"))).alias("bad_ids_sample"),
    )
    gates = (
        (Gate("close", "unmapped_category", 10), "unmapped"),
        (Gate("close", "repeated_transaction_id", 20), "bad_ids"),
        (Gate("close", "missing_counterparty", 30), "no_vendor"),
        (Gate("close", "missing_entity", 35), "no_entity"),
        (Gate("close", "outside_closed_window", 40, notice=not strict_window), "outside"),
    )
    return _rows(
        found,
        *[g.row(c, sample=f"{c}_sample") for g, c in gates],
    )


# --- per entity --------------------------------------------------------------


@dataclass(frozen=True)
class EntityPart:
    """What one subject adds to the rules per entity.

    ``rows`` have ``entity_id`` and columns of their own; ``sums`` say what becomes of
    these per entity (SQL, with a name), ``found`` what becomes of those over all entities,
    and ``gates`` are rows over that. An entity that a subject does not have is NULL there.
    """

    rows: DataFrame
    sums: tuple[str, ...]
    found: tuple[str, ...]
    gates: tuple[str, ...]


def entity_checks(*parts: EntityPart) -> DataFrame:
    """All rules per entity with one grouping, whatever number of subjects they have."""
    rows = parts[0].rows
    for part in parts[1:]:
        rows = rows.unionByName(part.rows, allowMissingColumns=True)
    per_entity = rows.groupBy("entity_id").agg(*[F.expr(x) for part in parts for x in part.sums])
    found = per_entity.selectExpr(*[x for part in parts for x in part.found])
    return _rows(found, *[x for part in parts for x in part.gates])


def opening_part(opening: DataFrame, roster: DataFrame) -> EntityPart:
    """Exactly one opening record for every entity that reports."""
    records = opening.select("entity_id", F.lit(1).alias("opening_record")).unionByName(
        roster.select("entity_id", F.lit(0).alias("opening_record"))
    )
    gate = Gate("close", "one_opening_record", 50)
    return EntityPart(
        records,
        ("sum(opening_record) AS openings",),
        (
            "count(openings) AS opening_entities",
            "coalesce(sum(openings), 0) AS opening_records",
            "count_if(openings <> 1) AS opening_wrong",
            "min(entity_id) FILTER (WHERE openings <> 1) AS opening_sample",
        ),
        (
            gate.row(
                "opening_wrong + if(opening_entities = 0, 1, 0)",
                "opening_records",
                "greatest(opening_entities, 1)",
                "opening_sample",
            ),
        ),
    )


def opening_checks(opening: DataFrame, roster: DataFrame) -> DataFrame:
    return entity_checks(opening_part(opening, roster))


def amount_part(actual: DataFrame, expected: DataFrame, gate: Gate) -> EntityPart:
    """``entity_id, amount`` against ``entity_id, expected_amount``, entities of either side.

    An agreement without any amount is a violation.
    """
    x = gate.check_id
    wrong = f"({x}_seen > 0 AND NOT coalesce({x}_amount = {x}_agreed, false))"
    rows = actual.select("entity_id", F.col("amount").alias(f"{x}_a"), F.lit(1).alias(f"{x}_s")).unionByName(
        expected.select("entity_id", F.col("expected_amount").alias(f"{x}_e"), F.lit(1).alias(f"{x}_s")),
        allowMissingColumns=True,
    )
    return EntityPart(
        rows,
        (f"sum({x}_a) AS {x}_amount", f"sum({x}_e) AS {x}_agreed", f"sum({x}_s) AS {x}_seen"),
        (
            f"count_if({wrong}) AS {x}_wrong",
            f"min(entity_id) FILTER (WHERE {wrong}) AS {x}_sample",
            f"sum({x}_amount) AS {x}_total",
            f"sum({x}_agreed) AS {x}_wanted",
            f"count({x}_agreed) AS {x}_agreements",
        ),
        (
            gate.row(
                f"{x}_wrong + if({x}_agreements = 0 AND {x}_wrong = 0, 1, 0)",
                f"{x}_total",
                f"{x}_wanted",
                f"{x}_sample",
            ),
        ),
    )


def opening_amount_part(opening: DataFrame, expected: DataFrame) -> EntityPart:
    actual = opening.select("entity_id", F.col("available_balance_usd").alias("amount"))
    return amount_part(actual, expected, Gate("report", "opening_amount", 90))


def opening_amount_checks(opening: DataFrame, expected: DataFrame) -> DataFrame:
    return entity_checks(opening_amount_part(opening, expected))


# --- control totals ----------------------------------------------------------


def control_totals(ledger: DataFrame) -> DataFrame:
    """Exact totals by section and direction, and the net change."""
    by_side = ledger.groupBy("cash_flow_section", "cash_direction").agg(
        F.sum("signed_amount").alias("amount")
    )
    with_net = by_side.select(
        F.inline(
            F.array(
                F.struct("cash_flow_section", "cash_direction", "amount"),
                F.struct(
                    F.lit("All").alias("cash_flow_section"),
                    F.lit("net").alias("cash_direction"),
                    F.col("amount"),
                ),
            )
        )
    )
    return with_net.groupBy("cash_flow_section", "cash_direction").agg(
        F.sum("amount").alias("amount")
    )


def compare_totals(totals: DataFrame, expected: DataFrame) -> DataFrame:
    """Every group of either side; a total that one side lacks does not agree."""
    keys = ["cash_flow_section", "cash_direction"]
    return expected.join(totals, keys, "full").select(
        *keys,
        "amount",
        "expected_amount",
        F.coalesce(F.col("amount") == F.col("expected_amount"), F.lit(False)).alias("agrees"),
    )


# Positions of the control gates: the order in which the figures are agreed.
CONTROL_ORDER = {
    "control_operating_inflow": 60,
    "control_operating_outflow": 61,
    "control_investing_outflow": 62,
    "control_financing_inflow": 63,
    "control_all_net": 64,
}
OTHER_CONTROL = 65


def control_checks(totals: DataFrame, expected: DataFrame) -> DataFrame:
    """One gate row per total of either side, and one that there is an agreement at all."""
    name = F.concat_ws(
        "_", F.lit("control"), F.lower("cash_flow_section"), F.lower("cash_direction")
    )
    position = F.lit(OTHER_CONTROL)
    for check_id, place in CONTROL_ORDER.items():
        position = F.when(F.col("check_id") == check_id, place).otherwise(position)
    compared = compare_totals(totals, expected).withColumn("check_id", name).select(
        F.lit("close").alias("stage"),
        "check_id",
        position.alias("ord"),
        F.when(F.col("agrees"), 0).otherwise(1).cast("bigint").alias("violations"),
        F.col("amount").cast("string").alias("observed"),
        F.col("expected_amount").cast("string").alias("expected"),
        F.lit(None).cast("string").alias("sample_key"),
        F.col("agrees").alias("passed"),
    )
    agreed = expected.agg(F.count("expected_amount").alias("n"))
    some = Gate("close", "control_agreement", 59).row("if(n = 0, 1, 0)", "if(n = 0, 'none', 'given')", "'given'")
    return _rows(agreed, some).unionByName(compared)


def agreement_notice(spark: SparkSession, missing: list[str]) -> DataFrame:
    """Says which figures of a run have no agreement to hold them against."""
    found = spark.range(1).select(
        F.lit(len(missing)).alias("n"), F.lit(", ".join(missing) or None).cast("string").alias("sample")
    )
    gate = Gate("close", "figures_without_agreement", 58, notice=True)
    return _rows(found, gate.row("n", sample="sample"))


# --- forecast ----------------------------------------------------------------


def forecast_part(forecast: DataFrame, roster: DataFrame, scenario: Scenario, lines: LineBook) -> EntityPart:
    """Row count and id uniqueness per entity."""
    wanted = scenario.forecast_months * len(lines)
    ids = forecast.select("entity_id", "transaction_id", F.lit(1).alias("n")).unionByName(
        roster.select("entity_id", F.lit(None).cast("string").alias("transaction_id"), F.lit(0).alias("n"))
    )
    per_id = ids.groupBy("entity_id", "transaction_id").agg(F.sum("n").alias("forecast_n"))
    short, repeated = f"forecast_rows <> {wanted}", "forecast_repeated > 0"
    return EntityPart(
        per_id.drop("transaction_id"),
        ("sum(forecast_n) AS forecast_rows", "count_if(forecast_n > 1) AS forecast_repeated"),
        (
            "count(forecast_rows) AS forecast_entities",
            "sum(forecast_rows) AS forecast_total",
            f"count_if({short}) AS forecast_short",
            f"min(entity_id) FILTER (WHERE {short}) AS forecast_short_sample",
            "sum(forecast_repeated) AS forecast_copies",
            f"min(entity_id) FILTER (WHERE {repeated}) AS forecast_copies_sample",
        ),
        (
            Gate("forecast", "forecast_row_count", 70).row(
                "forecast_short", "forecast_total", f"forecast_entities * {wanted}", "forecast_short_sample"
            ),
            Gate("forecast", "repeated_forecast_id", 75).row("forecast_copies", sample="forecast_copies_sample"),
        ),
    )


def forecast_checks(forecast: DataFrame, roster: DataFrame, scenario: Scenario, lines: LineBook) -> DataFrame:
    return entity_checks(forecast_part(forecast, roster, scenario, lines))


# --- per cell ----------------------------------------------------------------

#: Gate, level of the cells, and the two sides that have to agree.
CELL_GATES = (
    (Gate("forecast", "forecast_matches_drivers", 80), "line", "forecast", "driver"),
    (Gate("report", "line_equals_transactions", 110), "line", "report", "ledger"),
    (Gate("report", "activity_equals_transactions", 120), "activity", "report", "ledger"),
    (Gate("report", "section_equals_transactions", 130), "section", "report", "ledger"),
    (Gate("report", "report_matches_drivers", 220), "line", "open_report", "driver"),
)


def cell_checks(
    report_lines: DataFrame, summary: DataFrame, cash: DataFrame, forecast: DataFrame, drivers: DataFrame, scenario: Scenario
) -> DataFrame:
    """Report, both ledgers, forecast and drivers against each other, at every level, with one grouping.

    ``cash`` are the totals of both ledgers; ``drivers`` what drivers and plan say of each
    open cell. Every frame's cells are rows (level, side, amount); a side that has no
    row for a cell counts as zero, but a report or forecast has to have one.
    """

    def at(level: str, part, section=None):
        section = F.lit(None).cast("string") if section is None else F.col(section)
        return F.struct(F.lit(level).alias("level"), section.alias("section"), part.alias("part"))

    def cells(frame: DataFrame, side: str, *places, amount: str = "signed_amount_usd") -> DataFrame:
        return frame.select(
            "entity_id", "reporting_month", F.lit(side).alias("side"), F.col(amount).alias("amount"),
            F.inline(F.array(*places)),
        )

    line = at("line", F.col("reporting_line"))
    activity = at("activity", F.col("business_activity"), "cash_flow_section")
    section, net = at("section", F.col("cash_flow_section")), at("section", F.lit(NET_CHANGE))
    measures = [
        F.struct(F.lit(name).alias("part"), F.col(column).alias("signed_amount_usd"))
        for name, column in [*((s, net_column(s)) for s in SECTIONS), (NET_CHANGE, "net_change_in_cash")]
    ]
    by_section = summary.select("entity_id", "reporting_month", F.inline(F.array(*measures)))
    union = combine(
        cells(report_lines, "report", line, activity),
        cells(report_lines.filter(scenario.is_open(F.col("reporting_month"))), "open_report", line),
        cells(by_section, "report", at("section", F.col("part"))),
        cells(cash, "ledger", line, activity, section, net),
        cells(forecast, "forecast", line),
        cells(drivers, "driver", line),
    )
    sides = sorted({side for _, _, *two in CELL_GATES for side in two})
    sums = [f"sum(amount) FILTER (WHERE side = '{s}') AS {s}" for s in sides]
    seen = [f"count_if(side = '{s}') AS {s}_rows" for s in sides]
    per_cell = union.groupBy("level", "entity_id", "reporting_month", "section", "part").agg(
        *[F.expr(x) for x in (*sums, *seen)]
    )
    found, rows = [], []
    for gate, level, one, other in CELL_GATES:
        wrong = (
            f"(level = '{level}' AND {one}_rows + {other}_rows > 0 "
            f"AND NOT coalesce({one} = coalesce({other}, 0), false))"
        )
        x = gate.check_id
        found += [
            f"count_if({wrong}) AS {x}_n",
            f"coalesce(sum(coalesce({one}, 0) - coalesce({other}, 0)) FILTER (WHERE {wrong}), 0) AS {x}_off",
            f"min(concat_ws('/', entity_id, reporting_month, part)) FILTER (WHERE {wrong}) AS {x}_sample",
        ]
        rows.append(gate.row(f"{x}_n", f"{x}_off", sample=f"{x}_sample"))
    return _rows(per_cell.selectExpr(*found), *rows)


def unused_override_checks(unused: DataFrame) -> DataFrame:
    found = unused.agg(
        F.count("*").alias("n"),
        F.min(F.concat_ws("/", "entity_id", "reporting_month", "reporting_line")).alias("sample"),
    )
    gate = Gate("forecast", "unused_override", 85, notice=True)
    return _rows(found, gate.row("n", sample="sample"))


# --- report ------------------------------------------------------------------


def unknown_lines(totals: DataFrame, lines: LineBook) -> DataFrame:
    """Ledger totals of a line the report does not have; a NULL line is unknown too."""
    known = lines.frame(totals.sparkSession).select("reporting_line")
    return totals.join(known, "reporting_line", "left_anti")


def cash_checks(cash: DataFrame, scenario: Scenario, lines: LineBook) -> DataFrame:
    """Totals of both ledgers: they end with the horizon, and name known lines only.

    Counts instead of filtering, so the totals stay one shared shuffle with the
    other checks.
    """
    unknown = ~lines.knows(F.col("reporting_line"))
    amount = F.col("signed_amount_usd")
    found = cash.agg(
        F.max(F.when(amount.isNotNull(), F.col("reporting_month"))).alias("last"),
        F.count(F.when(unknown, 1)).alias("n"),
        F.coalesce(F.sum(F.when(unknown, amount)), F.lit(0)).alias("amount"),
        F.min(F.when(unknown, F.coalesce("reporting_line", F.lit("NULL")))).alias("sample"),
    )
    wanted = f"DATE '{scenario.last_month}'"
    return _rows(
        found,
        Gate("report", "horizon_end", 95).row(f"if(last <=> {wanted}, 0, 1)", "last", wanted),
        Gate("report", "unknown_reporting_line", 100).row("n", "amount", sample="sample"),
    )


def roll_forward_rows(summary: DataFrame, *keep: str) -> DataFrame:
    """Both identities of every month: inside the month, and with the month before."""
    by_month = Window.partitionBy("entity_id").orderBy("reporting_month")
    before = F.lag("ending_cash").over(by_month)
    return summary.select(
        "entity_id",
        "reporting_month",
        *keep,
        "beginning_cash",
        "net_change_in_cash",
        "ending_cash",
        before.alias("previous_ending_cash"),
    ).select(
        "*",
        F.coalesce(
            F.col("beginning_cash") + F.col("net_change_in_cash") == F.col("ending_cash"),
            F.lit(False),
        ).alias("adds_up"),
        F.coalesce(
            F.col("previous_ending_cash").isNull()
            | (F.col("previous_ending_cash") == F.col("beginning_cash")),
            F.lit(False),
        ).alias("continues"),
    )


def period_counts(report_lines: DataFrame, summary: DataFrame) -> DataFrame:
    """Rows per entity: lines, months, closed and open months, last month."""
    lines_per_entity = report_lines.groupBy("entity_id").agg(F.count("*").alias("line_rows"))
    actual = F.col("amount_type") == "Actual"
    months = summary.groupBy("entity_id").agg(
        F.count("*").alias("summary_rows"),
        F.sum(F.when(actual, 1).otherwise(0)).alias("actual_months"),
        F.sum(F.when(actual, 0).otherwise(1)).alias("forecast_months"),
        F.max("reporting_month").alias("last_month"),
    )
    return lines_per_entity.join(months, "entity_id", "full")


def line_part(report_lines: DataFrame, scenario: Scenario, lines: LineBook) -> EntityPart:
    """Every entity has one row per month and line."""
    rows = report_lines.select("entity_id", F.lit(1).alias("report_line"))
    return _counted(
        rows, ("count(report_line) AS line_rows",), "line_rows",
        {"line_row_count": (150, "line_rows", scenario.total_months * len(lines))},
    )


def line_checks(report_lines: DataFrame, scenario: Scenario, lines: LineBook) -> DataFrame:
    return entity_checks(line_part(report_lines, scenario, lines))


def summary_part(summary: DataFrame, scenario: Scenario) -> EntityPart:
    """Months per entity, and both balance identities, in one pass over the summary."""
    actual = F.col("amount_type") == "Actual"
    rows = roll_forward_rows(summary, "amount_type").select(
        "entity_id",
        F.col("reporting_month").alias("summary_month"),
        F.when(actual, 1).otherwise(0).alias("is_actual"),
        *[F.when(F.col(c), 0).otherwise(1).alias(f"not_{c}") for c in ("adds_up", "continues")],
    )
    wanted = {
        "summary_row_count": (140, "summary_rows", scenario.total_months),
        "actual_month_count": (170, "actual_months", scenario.actual_months),
        "forecast_month_count": (180, "forecast_months", scenario.forecast_months),
        "last_month": (190, "last_month", scenario.last_month),
    }
    identities = {"balance_adds_up": (160, "adds_up"), "balance_continues": (165, "continues")}
    sums = (
        "count(is_actual) AS summary_rows",
        "sum(is_actual) AS actual_months",
        "sum(1 - is_actual) AS forecast_months",
        "max(summary_month) AS last_month",
        "sum(not_adds_up) AS adds_up",
        "sum(not_continues) AS continues",
    )
    return _counted(rows, sums, "summary_rows", wanted, identities)


def summary_checks(summary: DataFrame, scenario: Scenario) -> DataFrame:
    return entity_checks(summary_part(summary, scenario))


def _counted(
    rows: DataFrame,
    sums: tuple[str, ...],
    counter: str,
    wanted: dict[str, tuple[int, str, object]],
    violations: dict[str, tuple[int, str]] | None = None,
) -> EntityPart:
    """Entities whose figure differs from the wanted one, and summed violation columns.

    An entity is the subject's if ``counter`` is above zero.
    """
    entities = f"{counter}_entities"
    found, gates = [f"count_if({counter} > 0) AS {entities}"], []
    for check_id, (position, column, value) in wanted.items():
        wrong = f"({counter} > 0 AND NOT (CAST({column} AS STRING) <=> '{value}'))"
        found += [
            f"count_if({wrong}) AS {column}_wrong",
            f"min(entity_id) FILTER (WHERE {wrong}) AS {column}_sample",
            f"max({column}) FILTER (WHERE {counter} > 0) AS {column}_seen",
        ]
        gates.append(
            Gate("report", check_id, position).row(
                f"{column}_wrong + if({entities} = 0, 1, 0)", f"{column}_seen", f"'{value}'", f"{column}_sample"
            )
        )
    for check_id, (position, column) in (violations or {}).items():
        found += [
            f"sum({column}) AS {column}_wrong",
            f"min(entity_id) FILTER (WHERE {column} > 0) AS {column}_sample",
        ]
        gates.append(Gate("report", check_id, position).row(f"{column}_wrong", sample=f"{column}_sample"))
    return EntityPart(rows, sums, tuple(found), tuple(gates))


def net_change_part(summary: DataFrame, expected: DataFrame) -> EntityPart:
    actual = summary.select("entity_id", F.col("net_change_in_cash").alias("amount"))
    return amount_part(actual, expected, Gate("report", "total_net_change", 200))


def net_change_checks(summary: DataFrame, expected: DataFrame) -> DataFrame:
    return entity_checks(net_change_part(summary, expected))


def final_balance_part(summary: DataFrame, expected: DataFrame) -> EntityPart:
    actual = final_balance(summary).select("entity_id", F.col("ending_cash").alias("amount"))
    return amount_part(actual, expected, Gate("report", "final_balance", 210))


def final_balance_checks(summary: DataFrame, expected: DataFrame) -> DataFrame:
    return entity_checks(final_balance_part(summary, expected))
