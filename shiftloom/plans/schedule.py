"""Schedule rules: codes, flags, units, coefficients, and the steps that apply overlays.

Everything here is a column expression or a narrow step on a frame whose overlay
payloads have been carried forward already, so steps compose without shuffles.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftloom.functions import dates, rules, text
from shiftloom.operators.joins import dealt_anew, spread_join
from shiftloom.operators.projection import q
from shiftloom.operators.timeline import Timeline
from shiftloom.plans import rule_tables as R

# -- codes and flags -----------------------------------------------------------


def code_group(code: Column | str, ruleset: str = "full") -> Column:
    """Group of a schedule code."""
    c = text.col_of(code).cast("string")
    tests = {
        "in": lambda arg: F.coalesce(c.isin(arg), F.lit(False)),
        "starts": lambda arg: text.starts(c, arg),
        "ends": lambda arg: text.ends(c, arg),
    }
    return rules.decision_list([(tests[t](arg), group) for t, arg, group in R.CODE_RULESETS[ruleset]], R.DEFAULT_GROUP)


def classify_codes(ruleset: str = "full", sheets: Sequence[str] = tuple(R.CODE_SHEETS)):
    """Code sheet (indice, code, description) to (code, codes_group)."""
    return lambda df: (
        df.where(F.col("indice").isin(list(sheets)))
        .select(F.col("code").cast("string").alias("code"))
        .distinct()
        .select("code", code_group("code", ruleset).alias("codes_group"))
    )


def flag_columns(value: Column | str, group: Column | str, null_cells: str = "off") -> dict[str, Column]:
    """Schedule, WD, LOA, PTO and Leave of a schedule cell.

    A null cell counts as off. With ``null_cells='legacy'`` it belongs to every code
    group at once: it is a scheduled working day, a leave and a vacation.
    """
    if null_cells not in ("off", "legacy"):
        raise ValueError("null_cells must be 'off' or 'legacy'")
    v, g = text.col_of(value), text.col_of(group)
    empty = v.isNull() if null_cells == "legacy" else F.lit(False)
    cell = v if null_cells == "legacy" else F.coalesce(v, F.lit(R.NO_SHIFT))
    return {
        "Schedule": rules.flag(~F.coalesce(cell.isin(R.OFF_CODES), F.lit(False))),
        "WD": rules.flag(g.isin("Work", "Trainees") | empty),
        "LOA": rules.flag((g == "LOA") | empty),
        "PTO": rules.flag((g == "Vacation") | empty),
        "Leave": rules.flag(cell.isin(R.DAY_OFF_CODES)),
    }


def code_groups_of(codes: DataFrame, value: str, out: str = "codes_group"):
    """Adds the group of each cell; cells that are not on the code list get none."""
    side = dealt_anew(codes.select(F.col("code").alias("__code"), F.col("codes_group").alias(out)), "__code")
    return lambda df: df.join(side, q(value) == F.col("__code"), "left").drop("__code")


def schedule_flags(codes: DataFrame, value: str = "value", null_cells: str = "off"):
    """The five flags from a classified code list."""
    return lambda df: (
        df.transform(code_groups_of(codes, value, "__group"))
        .withColumns(flag_columns(value, "__group", null_cells))
        .drop("__group")
    )


ABSENCE_MODES = ("main", "wfh", "2022", "2024")


def absence_flag(mode: str = "main", *, wd: str = "WD", schedule: str = "Schedule", status: str = "rta_status",
                 hours: str = "srtf_total_hrs", forecast: str = "ABS_FCST",
                 attendance: str = "iw_attendance_status") -> Column:
    """Absence on a working day, by one of the four rule sets."""
    if mode not in ABSENCE_MODES:
        raise ValueError(f"mode must be one of {ABSENCE_MODES}")
    working = F.col(wd) == 1
    absent = F.col(status) == "Abs"
    few_hours = (F.col(hours) < 1) | F.col(hours).isNull()
    foreseen = F.col(forecast) == 1
    if mode == "2024":
        return rules.flag((working & (F.col(schedule) < 1)) | foreseen)
    if mode == "2022":
        return rules.flag(working & absent & few_hours)
    seen = working & absent if mode == "wfh" else working & absent & few_hours
    return rules.flag(seen | (foreseen & F.col(attendance).isNull()))


def shift_bucket(value: Column | str) -> Column:
    return rules.decision_list([(text.has(value, part), shift) for part, shift in R.SHIFT_RULES], R.NO_SHIFT)


# -- unit, line of business ----------------------------------------------------


def business_unit(lob: Column | str) -> Column:
    c = text.col_of(lob)
    return rules.decision_list(
        [
            (c == R.CUSTOMER_LOB, R.CUSTOMER_UNIT),
            (text.starts(c, R.COMMUNITY_PREFIX), R.COMMUNITY_UNIT),
            (c.isin(R.COMMUNITY_LOBS), R.COMMUNITY_UNIT),
        ],
        c,
    )


def line_of_business(unit: Column | str, flow: Column | str, lob: Column | str, after_changes: bool = False) -> Column:
    """LOB from (unit, flow); a pair without a rule keeps its LOB.

    After the change log every customer-support row gets its LOB, before it only
    those of one flow.
    """
    u, f = text.col_of(unit), text.col_of(flow)
    customer = u == R.CUSTOMER_UNIT
    chain = [
        ((u == R.LERT) & (f == R.LERT), R.LERT),
        (customer if after_changes else customer & (f == R.CUSTOMER_FLOW), R.CUSTOMER_LOB),
    ]
    chain += [((u == R.COMMUNITY_UNIT) & (f == flow_name), name) for flow_name, name in R.COMMUNITY_FLOWS.items()]
    return rules.last_match(chain, lob)


def settle_lob(unit: str, flow: str, lob: str, changed: Column):
    """Second LOB pass, then the customer-support flow, then the support functions.

    ``changed`` is true for entities with a flow change on record.
    """
    return lambda df: (
        df.withColumn(lob, line_of_business(unit, flow, lob, after_changes=True))
        .withColumn(flow, rules.override(flow, F.col(lob) == R.CUSTOMER_LOB, R.CUSTOMER_FLOW))
        .withColumn(lob, rules.override(lob, F.col(flow).isin(R.SUPPORT_FLOWS) & changed, R.SUPPORT_LOB))
    )


def market_rules(market: str, flow: str, lob: str):
    """LOB and flow that follow from two markets."""
    m = F.col(market)
    return lambda df: df.withColumns(
        {
            lob: rules.last_match([(m == R.HESITANCY_MARKET, R.HESITANCY_LOB), (m == R.ITALIAN_MARKET, R.ITALIAN_LOB)], lob),
            flow: rules.override(flow, m == R.ITALIAN_MARKET, R.ITALIAN_FLOW),
        }
    )


def dated_override(unit: str, lob: str, date: str = "date", since: dt.date | None = R.UNIT_MERGE_DATE):
    """Customer support merged into the community unit, from a date on (or always)."""
    due = F.lit(True) if since is None else F.col(date) >= F.lit(since)
    return lambda df: df.withColumns(
        {
            unit: rules.override(unit, due & (F.col(unit) == R.CUSTOMER_UNIT), R.COMMUNITY_UNIT),
            lob: rules.override(lob, due & (F.col(lob) == R.CUSTOMER_LOB), R.MERGED_LOB),
        }
    )


# -- steps on carried overlays ---------------------------------------------------


def apply_exit(value: str, mark: str, date: str, end: str, roll_off_serial: str | None = None):
    """After the end date the cell is ``-``; on that day the exit is marked.

    With ``roll_off_serial`` this holds only where the sheet has no roll-off date.
    """
    open_ended = F.lit(True)
    if roll_off_serial is not None:
        open_ended = (q(roll_off_serial).cast("int") == 0) | q(roll_off_serial).isNull()
    return lambda df: df.withColumns(
        {
            value: rules.override(value, (F.col(date) > F.col(end)) & open_ended, R.NO_SHIFT),
            mark: rules.override(q(mark), (F.col(date) == F.col(end)) & open_ended, "roll_off"),
        }
    )


def apply_forecasts(out: str, value: str, date: str, intervals: Sequence[tuple[str, str]], attrition: str | None):
    """1 on forecast absences (day-off cells exempt) and after a forecast attrition."""
    v = F.col(value)
    at_work = ~F.coalesce(v.isin(R.DAY_OFF_CODES), F.lit(False))
    chain = [(F.col(date).between(F.col(lo), F.col(hi)) & at_work, 1) for lo, hi in intervals]
    if attrition is not None:
        chain.append(((F.col(date) > F.col(attrition)) & rules.not_equal(v, R.NO_SHIFT), 1))
    return lambda df: df.withColumn(out, rules.decision_list(chain, F.lit(None).cast("int")))


def apply_cross_skill(unit: str, flow: str, date: str, effective: str, new_unit: str, new_flow: str, run_date: dt.date):
    """Unit and flow of a finished training; flow names are then spelled alike."""
    due = (F.col(date) >= F.col(effective)) & dates.after_horizon(effective, run_date, 2)
    return lambda df: df.withColumns(
        {
            unit: rules.override(unit, due, F.col(new_unit)),
            flow: text.replace_chain(rules.override(flow, due, F.col(new_flow)), R.FLOW_SPELLING),
        }
    )


def roll_off_status(status: str, date: str, roll_off: str, mark: str):
    """Active (or unknown) becomes Rolled-Off after the roll-off date; the day is marked."""
    active = (F.col(status) == "Active") | F.col(status).isNull()
    real = F.col(roll_off) != F.lit(dt.date(1900, 1, 1))
    return lambda df: df.withColumns(
        {
            mark: rules.override(q(mark), F.col(roll_off) == F.col(date), "roll_off"),
            status: rules.override(status, active & (F.col(date) > F.col(roll_off)) & real, "Rolled-Off"),
        }
    )


def promote_trainees(line: Timeline, role: str, date: str, working: Column):
    """A trainee is an analyst from the first day with a working code on."""

    def op(df: DataFrame) -> DataFrame:
        first = line.first_where(df, {"__promoted": (working & (F.col(role) == "Trainee"), date)})
        due = (F.col(role) == "Trainee") & (F.col(date) >= F.col("__promoted"))
        return first.withColumn(role, rules.override(role, due, "Analyst")).drop("__promoted")

    return op


def promote_billable(line: Timeline, role: str, status: str, billable: str, date: str, working: Column):
    """An active analyst is billable from the first non-billable working day on."""

    def op(df: DataFrame) -> DataFrame:
        waiting = working & (F.col(role) == "Analyst") & (F.col(billable) == "non-billable")
        first = line.first_where(df, {"__billable": (waiting, date)})
        due = (F.col(role) == "Analyst") & (F.col(status) == "Active") & (F.col(date) >= F.col("__billable"))
        return first.withColumn(billable, rules.override(billable, due, "billable")).drop("__billable")

    return op


def tenure_class(date: str, deployed: str, graduated: str, roll_in_serial: str, status: str) -> Column:
    """Trainee, DMR or Tenured; null where nothing is known."""
    d, dep, grad, roll_in = F.col(date), F.col(deployed), F.col(graduated), q(roll_in_serial).cast("int")
    undeployed = dep.isNull()
    active = undeployed & (F.col(status) == "Active")
    trained = F.date_add(dates.serial_to_date(roll_in), R.TRAINING_DAYS)
    return rules.decision_list(
        [
            (d < dep, "Trainee"),
            ((d >= dep) & (d < grad), "DMR"),
            (d >= grad, "Tenured"),
            (undeployed & (roll_in < R.LONG_TENURE_SERIAL), "Tenured"),
            (active & (d > trained), "Tenured"),
            (active & (d <= trained), "Trainee"),
        ],
        F.lit(None).cast("string"),
    )


def attribute_change(line: Timeline, role: str, unit: str, flow: str, market: str):
    """``old to new`` on the day before a change of role, or of unit, flow and market.

    Only rows with all four attributes remain. "Next" is the next row on which the
    attribute and those before it in the list are set.
    """

    def op(df: DataFrame) -> DataFrame:
        nxt, usable = {}, F.lit(True)
        for c in (role, unit, flow, market):
            usable = usable & F.col(c).isNotNull()
            nxt[f"__next_{c}"] = F.when(usable, F.col(c))
        rows = line.following(df, nxt).where(usable)

        def after(c: str) -> Column:
            return F.coalesce(F.col(f"__next_{c}"), F.col(c))

        def joined(cols: Sequence[Column]) -> Column:
            return F.concat(cols[0], F.lit("_"), cols[1], F.lit("_"), cols[2])

        trio = (unit, flow, market)
        moved = (F.col(unit) != after(unit)) | (F.col(flow) != after(flow)) | (F.col(market) != after(market))
        change = F.concat(joined([F.col(c) for c in trio]), F.lit(" to "), joined([after(c) for c in trio]))
        return rows.withColumns(
            {
                "role_change": F.when(F.col(role) != after(role), F.concat(F.col(role), F.lit(" to "), after(role))),
                "cross_change": text.replace_chain(F.when(moved, change), R.CHANGE_ABBREVIATIONS),
            }
        ).drop(*nxt)

    return op


# -- weekly coefficient ------------------------------------------------------------


def coefficient_rules(total: Column, days: Column, mark: Column, schedule: Column, leave: Column,
                      weekday: Column, default: float | None = 0.0) -> Column:
    """Weight of a day in its week, from the week's scheduled and leave days.

    ``mark`` is 1 where the week's closing Friday is a leave day after four scheduled
    days, else null.
    """
    full, on, off = total == 7, schedule == 1, leave == 1
    plain = full & mark.isNull()
    short_week = F.lit(5.0) / F.lit(7.0)
    return rules.decision_list(
        [
            (full & (days == 6), short_week),
            (full & (mark == 1) & (on | (weekday == 4)) & (days <= 4), 1.0),
            (plain & on & (days == 5), 1.0),
            (plain & (on | off) & (days == 4), short_week),
            (plain & (on | off) & (days == 3), short_week),
            ((total < 7) & on, 1.0),
        ],
        F.lit(default).cast("double"),
    )


def _coefficient(df: DataFrame, keys: Sequence[str], date: str, schedule: str, leave: str,
                 default: float | None, out: str, totals: Sequence[str] | None = None) -> DataFrame:
    """``keys`` end with the Saturday-to-Friday week. Its Friday comes last, so a mark
    filled backwards from there reaches every day of the week: it is the week's maximum.
    ``totals`` are summed over the week where ``schedule`` and ``leave`` stand on every row of a day."""
    week = Window.partitionBy(*keys)
    worked, off = totals or (schedule, leave)
    friday_leave = (F.weekday(F.col(date)) == 4) & (F.col(leave) == 1) & (F.col("__days") == 4)
    return (
        df.withColumns({"__days": F.sum(worked).over(week), "__off": F.sum(off).over(week)})
        .withColumn("__mark", F.max(F.when(friday_leave, F.lit(1))).over(week))
        .withColumn(
            out,
            coefficient_rules(
                F.col("__days") + F.col("__off"), F.col("__days"), F.col("__mark"),
                F.col(schedule), F.col(leave), F.weekday(F.col(date)), default,
            ),
        )
        .drop("__days", "__off", "__mark")
    )


def weekly_coefficient(entity: str = "EID", week: str = "week_ending", date: str = "date",
                       schedule: str = "Schedule", leave: str = "Leave",
                       default: float | None = 0.0, out: str = "WSC", bounded: bool = False):
    """Coefficient of every row of any fact.

    The fact is first summed to one row per (entity, day), so that the windows see at
    most seven rows whatever the entity, and the result is joined back. That makes the
    fact several times over. Where the calendar bounds the rows per entity (``bounded``) the days are
    summed in windows instead: the same results, and the fact is made once. All rows of a day
    stand in one week.
    """

    def op(df: DataFrame) -> DataFrame:
        if bounded:
            day, keyed = Window.partitionBy(entity, week, date), " AND ".join(f"`{c}` IS NOT NULL" for c in (entity, week, date))
            own = df.withColumns({c: F.when(F.expr(keyed), F.col(v)) for c, v in (("__s", schedule), ("__l", leave))})
            summed = own.withColumns({"__s_day": F.sum("__s").over(day), "__l_day": F.sum("__l").over(day)})
            weighed = _coefficient(summed, [entity, week], date, "__s_day", "__l_day", default, out, ["__s", "__l"])
            return weighed.withColumn(out, F.when(F.expr(keyed), F.col(out))).drop("__s", "__l", "__s_day", "__l_day")
        daily = (
            df.dropna("any", subset=[entity, week, date])
            .groupBy(entity, week, date)
            .agg(F.sum(schedule).alias("__s"), F.sum(leave).alias("__l"), F.count(F.lit(1)).alias("__n"))
        )
        weights = _coefficient(daily, [entity, week], date, "__s", "__l", default, out)
        return spread_join(df, weights.select(entity, date, out), [entity, date], daily.select(entity, date, "__n"))

    return op


def weekly_coefficient_in_place(keys: Sequence[str], week: str = "week_ending", date: str = "date",
                                schedule: str = "Schedule", leave: str = "Leave",
                                default: float | None = 0.0, out: str = "WSC"):
    """The same for rows that are one per (keys, day) by construction: no join."""
    return lambda df: _coefficient(df, [*keys, week], date, schedule, leave, default, out)
