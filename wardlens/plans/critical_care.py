"""Questions on the critical-care tables, each one a query over whole tables.

``t`` is any object whose attributes are the tables ``baseline``,
``nursingchart``, ``transfer``, ``drugs``, ``lab``, ``icd`` and ``outcome``;
``registry.Tables`` reads them from a Parquet folder.  Charts, labs and codes
join on the stay number ``inp_no``, the rest on ``patient_id``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardlens.functions import dates, numbers, text
from wardlens.operators import (
    aggregates, crosstabs, filters, joins, percentiles, ranking, reports, sampling, setops, windows,
)
from wardlens.operators.keys import join_back
from wardlens.sources import maintenance
from wardlens.sources.staging import save_table
from wardlens.sources.tables import as_view

PATIENT, STAY = "patient_id", "inp_no"
QUESTIONS: dict[str, Callable[..., DataFrame]] = {}


def question(number: str):
    """List a function under its question number (``A`` for the additional ones)."""

    def register(fn):
        QUESTIONS[number] = fn
        return fn

    return register


def charted(t, *columns: str, who: Column | None = None) -> DataFrame:
    """Chart rows with the patient of their stay; only the named columns are read."""
    patients = t.baseline if who is None else t.baseline.filter(who)
    chart = [c for c in columns if c in t.nursingchart.columns]
    person = [c for c in columns if c not in chart]
    return t.nursingchart.select(STAY, *chart).join(patients.select(STAY, PATIENT, *person), STAY)


def rows_per(df: DataFrame, *keys: str, out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def hours(start: str = "starttime", stop: str = "stoptime") -> Column:
    return dates.hours_between(F.col(start), F.col(stop))


def rounded_mean(column: str, digits: int = 2) -> Column:
    return numbers.round_half_up(F.avg(column), digits)


def discharge_year_less_age() -> Column:
    return dates.birth_year(F.col("icu_discharge_time"), F.col("age"))


@question("2")
def transfers_after_admission(t) -> DataFrame:
    """Every transfer later than a patient's earliest admission, beside each admitting department."""
    admitted = t.transfer.filter(F.col("startreason") == "Admission")
    departments = admitted.groupBy(PATIENT, F.col("transferdept").alias("admitted_dept")).agg(
        F.min("starttime").alias("admission_time")
    )
    moves = t.transfer.filter(F.col("startreason") == "Transfer")
    later = joins.rows_after_first(moves, admitted, [PATIENT], "starttime", "first_time")
    later = later.select(PATIENT, F.col("startreason").alias("reason"),
                         F.col("starttime").alias("transfer_time"), "transferdept").distinct()
    return later.join(departments, PATIENT)


@question("3")
def pressure_above_icu_median(t) -> DataFrame:
    """Each stay's highest, then latest, systolic pressure where above the ICU median."""
    chart = charted(t, "invasive_sbp", "charttime", "admitdept").filter(F.col("invasive_sbp").isNotNull())
    median = percentiles.percentiles(
        chart.filter(F.col("admitdept") == "ICU"), [], "invasive_sbp", {"m": 0.5}
    ).scalar()
    above = chart.withColumn("median_icu", median).filter(F.col("invasive_sbp") > F.col("median_icu"))
    best = ranking.top_rows(
        above, [STAY], [F.desc("invasive_sbp"), F.desc_nulls_last("charttime"), F.col(PATIENT)], 1
    )
    return best.select("admitdept", PATIENT, F.col("invasive_sbp").alias("systolic_bp"), "median_icu", "charttime")


@question("4")
def last_drugs(t, limit: int | None = None) -> DataFrame:
    """Drugs given at each patient's latest drug time, or the first ``limit`` of them by name."""
    return ranking.rows_at_last_time(
        t.drugs, [PATIENT], "drug_time", [F.col("drugname"), F.col("formula")], limit
    ).select(PATIENT, "drugname", "drug_time", "formula")


@question("5")
def recent_transfers(t, n: int = 5) -> DataFrame:
    return ranking.top_rows(
        t.transfer, [PATIENT],
        [F.desc_nulls_first("stoptime"), F.desc("starttime"), F.col("transferdept"), F.col(STAY)], n, "row_num",
    )


@question("6")
def rolling_heart_rate(t) -> DataFrame:
    beats = t.nursingchart.filter(F.col("heart_rate").isNotNull()).select(STAY, "charttime", "heart_rate")
    means = windows.running_mean(beats, [STAY], ["charttime", "heart_rate"], "heart_rate", "rolling")
    return means.withColumn("rolling", numbers.round_half_up(F.col("rolling"), 2))


@question("7")
def back_to_surgery(t) -> DataFrame:
    """Stays in surgery that directly follow a pre-discharge stay of the same patient."""
    rows = windows.neighbours(
        t.transfer, [PATIENT], ["starttime", "stoptime", "transferdept", STAY],
        {"previous_stop": ("stopreason", 1)},
    )
    return rows.filter(
        (F.col("previous_stop") == "Patient pre discharge") & (F.col("transferdept") == "Surgery")
    )


@question("8")
def mean_age_by_dept_and_sex(t) -> DataFrame:
    return t.baseline.groupBy("admitdept", "sex").agg(F.ceil(F.avg("age")).alias("avg_age"))


@question("9")
def top_blood_sugar(t, q: float = 0.99) -> DataFrame:
    """Blood sugars at or above their stay's own percentile, with that percentile."""
    chart = t.nursingchart.filter(F.col("blood_sugar").isNotNull()).select(STAY, "charttime", "blood_sugar")
    limits = percentiles.percentiles(chart, [STAY], "blood_sugar", {"limit": q})
    high = join_back(chart, limits, [STAY], "inner").filter(F.col("blood_sugar") >= F.col("limit"))
    return high.join(t.baseline.select(STAY, PATIENT), STAY).distinct()


@question("10")
def last_letters(t, n: int = 6) -> DataFrame:
    names = t.icd.select("icd_desc").distinct()
    return names.withColumn("last_letters", text.last_chars(F.col("icd_desc"), n))


@question("11")
def top_drug_by_dept(t) -> DataFrame:
    """The drug given most often in each department, by total count."""
    given = t.drugs.groupBy(PATIENT, "drugname").agg(F.count(F.lit(1)).alias("n"))
    by_dept = given.join(t.baseline.select(PATIENT, "admitdept").distinct(), PATIENT)
    totals = by_dept.groupBy("admitdept", "drugname").agg(F.sum("n").alias("times_given"))
    return ranking.top_values(totals, ["admitdept"], "times_given").drop("rank")


@question("12")
def letter_position(t, letter: str = "y") -> DataFrame:
    place = text.position_of(F.col("icd_desc"), letter)
    names = t.icd.filter(place > 0).select("icd_desc").distinct()
    return names.withColumn("position", place).orderBy(F.desc("position"), "icd_desc")


@question("13")
def oldest_by_dept(t, n: int = 3) -> DataFrame:
    best = ranking.top_values(t.baseline, ["admitdept"], "age", n, "rank_num", dense=True)
    return best.select(PATIENT, "admitdept", "age", "sex", "rank_num")


@question("14")
def discharged_in(t, year: int = 2020) -> DataFrame:
    return t.baseline.filter(filters.year_is("icu_discharge_time", year)).agg(F.count(PATIENT).alias("patients"))


@question("15")
def icu_days(t) -> DataFrame:
    moved = t.transfer.filter((F.col("transferdept") == "ICU") & (F.col("startreason") == "Transfer"))
    days = F.sum(dates.whole_days_between(F.col("starttime"), F.col("stoptime"))).alias("icu_days")
    return moved.groupBy(PATIENT).agg(days).filter(F.col("icu_days") != 0).orderBy(F.desc("icu_days"), PATIENT)


@question("16")
def pressure_by_patient(t) -> DataFrame:
    chart = charted(t, "invasive_sbp", "admitdept").filter(F.col("invasive_sbp").isNotNull())
    return chart.groupBy("admitdept", PATIENT).agg(
        F.min("invasive_sbp").alias("min_sbp"), F.max("invasive_sbp").alias("max_sbp"),
        numbers.truncate(F.avg("invasive_sbp"), 2).alias("avg_sbp"),
    )


@question("17")
def patients_per_dept(t, path: str | None = None) -> DataFrame:
    """Patients per department, written as a table when a path is given."""
    counts = t.baseline.groupBy("admitdept").agg(F.count(PATIENT).alias("patients"))
    return counts if path is None else save_table(counts, path)


@question("18")
def most_surgeries(t, n: int = 3) -> DataFrame:
    moved = t.transfer.filter((F.col("startreason") == "Transfer") & (F.col("transferdept") == "Surgery"))
    return rows_per(moved, PATIENT, out="surgeries").orderBy(F.desc("surgeries"), PATIENT).limit(n)


@question("19")
def pain_score_is(t, score: str = "0") -> DataFrame:
    return charted(t, "cpot_pain_score").filter(F.col("cpot_pain_score") == score).select(
        PATIENT, "cpot_pain_score"
    ).distinct()


@question("20")
def pressure_falls(t, days: int = 3) -> DataFrame:
    """Days that end three adjacent days of falling systolic and diastolic daily means."""
    known = t.nursingchart.filter(
        F.col("invasive_sbp").isNotNull() & F.col("invasive_diastolic_blood_pressure").isNotNull()
    )
    daily = windows.daily_mean(
        known, [STAY], "charttime", {"sbp": "invasive_sbp", "dbp": "invasive_diastolic_blood_pressure"}
    )
    return windows.falling_days(daily, [STAY], "day", ["sbp", "dbp"], days)


@question("21")
def health_of_fast_breathers(t, above: float = 20) -> DataFrame:
    fast = charted(t, "breathing").filter(F.col("breathing") > above)
    peak = fast.groupBy(PATIENT).agg(F.max("breathing").alias("max_breathing"))
    health = t.outcome.filter(F.col("sf36_generalhealth").isNotNull()).select(PATIENT, "sf36_generalhealth").distinct()
    return peak.join(health, PATIENT).orderBy("max_breathing", PATIENT)


@question("22")
def heart_rate_outliers(t, k: float = 2.0) -> DataFrame:
    """The highest outlying heart rate of each patient, outliers measured over all readings."""
    out = filters.sigma_outliers(t.nursingchart.select(STAY, "heart_rate"), "heart_rate", k)
    joined = out.join(t.baseline.select(STAY, PATIENT), STAY)
    return joined.groupBy(PATIENT).agg(F.max("heart_rate").alias("heart_rate"))


@question("24")
def fever(t, above: float = 38) -> DataFrame:
    hot = charted(t, "temperature").filter(F.col("temperature") > above)
    return hot.groupBy(PATIENT).agg(F.max("temperature").alias("temperature"))


@question("26")
def sugar_discharge_correlation(t) -> DataFrame:
    chart = charted(t, "blood_sugar", "icu_discharge_time")
    seconds = dates.epoch_seconds(F.col("icu_discharge_time"))
    return chart.agg(aggregates.correlation(seconds, F.col("blood_sugar")).alias("correlation"))


@question("27")
def age_groups(t) -> DataFrame:
    age = F.col("age")
    return t.baseline.agg(
        aggregates.count_where(age < 30).alias("under_30"),
        aggregates.count_where((age >= 30) & (age <= 60)).alias("from_30_to_60"),
        aggregates.count_where(age > 60).alias("over_60"),
    )


@question("28")
def least_busy_discharge_hour(t) -> DataFrame:
    known = t.baseline.filter(F.col("icu_discharge_time").isNotNull())
    best = ranking.most_frequent(
        known.select(F.hour("icu_discharge_time").alias("hour")), [], "hour", "discharges", least=True
    )
    return best.select(dates.hour_slot(F.col("hour")).alias("slot"), "discharges")


@question("29")
def random_with_infection(t, site: str = "UTI", n: int = 3, seed: str = "site") -> DataFrame:
    return sampling.random_rows(t.baseline.filter(F.col("infectionsite") == site), [PATIENT, STAY], n, seed)


@question("30")
def mean_stay_hours(t, site: str = "Soft Tissue") -> DataFrame:
    joined = t.transfer.join(t.baseline.filter(F.col("infectionsite") == site).select(PATIENT), PATIENT)
    return joined.agg(F.avg(hours()).alias("avg_hours"))


@question("31")
def born_in(t, year: int, path: str) -> DataFrame:
    """Patients born in a year, stored as a table."""
    born = t.baseline.filter(discharge_year_less_age() == year)
    return save_table(
        born.select(PATIENT, "age", "sex", F.year("icu_discharge_time").alias("discharge_year")), path
    )


@question("32")
def daily_peaks(t, dept: str = "Surgery") -> DataFrame:
    chart = charted(t, "charttime", "temperature", "heart_rate", who=F.col("admitdept") == dept)
    return chart.groupBy(F.to_date("charttime").alias("record_day")).agg(
        F.max("temperature").alias("highest_temp"), F.max("heart_rate").alias("highest_hr")
    ).orderBy("record_day")


@question("33")
def heart_rate_jumps(t, above_pct: float = 30) -> DataFrame:
    beats = t.nursingchart.select(STAY, "charttime", "heart_rate")
    jumps = windows.percent_jumps(
        beats, [STAY], ["charttime", "heart_rate"], "heart_rate", above_pct, "prev_heart_rate", "increase_pct"
    )
    return jumps.withColumn("increase_pct", numbers.round_half_up(F.col("increase_pct"), 2)).join(
        t.baseline.select(STAY, PATIENT), STAY
    )


@question("34")
def fed_without_urine(t) -> DataFrame:
    return t.nursingchart.filter(
        F.col("milk").isNotNull() & F.col("soft_food").isNotNull() & (F.col("urine_volume") == 0)
    )


@question("35")
def transfers_by_dept(t) -> DataFrame:
    names = {"ICU": "dpt1", "Surgery": "dpt2", "Medical Specialties": "dpt3"}
    return crosstabs.crosstab(t.transfer, [PATIENT], "transferdept", names)


@question("36")
def normal_ages(t, sd: float = 3.0, n: int = 100, seed: str = "ages") -> DataFrame:
    """n normally distributed ages around the third-lowest distinct age of the table."""
    known = t.baseline.filter(F.col("age").isNotNull())
    third = known.select("age").distinct().orderBy("age").offset(2).limit(1).scalar()
    draws = t.baseline.sparkSession.range(n)
    return draws.select(
        F.round(sampling.normal_draw(third.cast("double"), sd, F.col("id"), seed)).cast("int").alias("generated_age")
    )


@question("37")
def vigorous_without_pain(t) -> DataFrame:
    kept = t.outcome.filter(
        F.col("sf36_activitylimit_vigorousactivity").isNotNull() & (F.col("sf36_pain_bodypainpast4wk") == "1_None")
    )
    return kept.select(PATIENT, "sf36_activitylimit_vigorousactivity", "sf36_pain_bodypainpast4wk")


@question("38")
def poor_health_view(t) -> DataFrame:
    poor = t.outcome.filter(F.col("sf36_generalhealth") == "5_Poor")
    return as_view(poor.select(PATIENT, "sf36_generalhealth"), "poor_health_patients")


@question("39")
def disease_exists(t, codes: DataFrame) -> DataFrame:
    """A found flag for each requested ``icd_code``."""
    return filters.exists_flag(codes.select("icd_code"), t.icd, ["icd_code"])


@question("40")
def top_drug_of_never_intubated(t) -> DataFrame:
    """The drug given most often to patients without any extubation on their charts."""
    tube_out = charted(t, "extubation").filter(F.col("extubation"))
    given = filters.without_keys(t.drugs, tube_out, [PATIENT])
    return ranking.most_frequent(given, [], "drugname", "times_given")


@question("41")
def with_birth_year(t) -> DataFrame:
    return maintenance.add_columns(t.baseline, birthyear=discharge_year_less_age())


@question("42")
def diseases_ending(t, ending: str = "itis") -> DataFrame:
    return t.icd.filter(F.col("icd_desc").rlike(f"{ending}$")).select("icd_desc").distinct()


@question("43")
def patient_report(t) -> DataFrame:
    """Three chart means and the number of drugs for every patient."""
    chart = charted(t, "blood_sugar", "temperature", "heart_rate")
    means = {
        f"{c}_avg": rounded_mean(c) for c in ("blood_sugar", "temperature", "heart_rate")
    }
    return aggregates.entity_summary(
        t.baseline.select(PATIENT).distinct(), [PATIENT],
        [(chart, means), (t.drugs, {"drug_count": F.count(F.lit(1))})], ["drug_count"],
    )


@question("45")
def health_of_unsteady_sugar(t, deviation_above: float = 2.0) -> DataFrame:
    spread = charted(t, "blood_sugar").groupBy(PATIENT).agg(F.stddev_samp("blood_sugar").alias("sd"))
    unsteady = spread.filter(F.col("sd") > deviation_above)
    known = t.outcome.filter(F.col("sf36_generalhealth").isNotNull())
    return filters.within_keys(known, unsteady, [PATIENT]).select(PATIENT, "sf36_generalhealth")


@question("46")
def time_by_dept_and_outcome(t) -> DataFrame:
    vital = t.outcome.filter(F.col("follow_vital").isin("Alive", "Death")).select(PATIENT, "follow_vital")
    return t.transfer.join(vital, PATIENT).groupBy("transferdept", "follow_vital").agg(
        numbers.round_half_up(F.avg(hours()), 2).alias("avg_hours")
    )


@question("48")
def oxygen_against_mean(t, dept: str = "ICU") -> DataFrame:
    """Highest oxygen saturation per patient of a department against the mean of all readings."""
    mean = t.nursingchart.agg(rounded_mean("blood_oxygen_saturation")).scalar()
    chart = charted(t, "blood_oxygen_saturation", who=F.col("admitdept") == dept)
    peak = chart.groupBy(PATIENT).agg(F.max("blood_oxygen_saturation").alias("max_oxygen"))
    peak = peak.withColumn("avg_oxygen", mean)
    status = (
        F.when(F.col("max_oxygen") > F.col("avg_oxygen"), "Above Average")
        .when(F.col("max_oxygen") < F.col("avg_oxygen"), "Below Average").otherwise("Equal to Average")
    )
    return peak.withColumn("oxygen_status", status)


@question("49")
def poor_health_by_dept(t) -> DataFrame:
    known = t.baseline.filter(F.col("icu_discharge_time").isNotNull()).select(PATIENT, "icu_discharge_time")
    poor = (
        (F.col("follow_vital") == "Alive") & (F.col("sf36_generalhealth") == "5_Poor")
        & (F.col("follow_date") > F.col("icu_discharge_time"))
    )
    return aggregates.group_rate(t.outcome.join(known, PATIENT), ["discharge_dept"], poor, "poor_health_pct")


@question("50")
def mean_temperature_on(t, days: Sequence[str]) -> DataFrame:
    found = reports.mean_of_days(t.nursingchart, "charttime", "temperature", days)
    return found.withColumn("mean", numbers.round_half_up(F.col("mean"), 2))


@question("51")
def icu_after_surgery(t) -> DataFrame:
    rows = windows.state_transitions(
        t.transfer, [PATIENT], ["starttime", "stoptime", "transferdept", STAY], "transferdept", "Surgery", "ICU",
        carry={"next_dept": ("transferdept", -1)},
    )
    return rows.select(
        PATIENT, STAY, F.col("starttime").alias("icu_starttime"), F.col("stoptime").alias("icu_endtime"),
        F.col("previous_state").alias("prev_dept"), "next_dept",
        numbers.round_half_up(hours(), 2).alias("time_spent_hours"),
    )


@question("52")
def drugs_between(t, start: str = "04:00:00", stop: str = "05:00:00") -> DataFrame:
    given = t.drugs.filter(dates.within_time_of_day(F.col("drug_time"), start, stop))
    return given.select("drugname", F.date_format("drug_time", "HH:mm:ss").alias("clock")).distinct()


@question("53")
def rank_by_icu_visits(t) -> DataFrame:
    visits = rows_per(t.transfer.filter(F.col("transferdept") == "ICU"), PATIENT, out="icu_visits")
    return ranking.global_rank(visits, ["icu_visits"], [True])


@question("54")
def dept_share(t) -> DataFrame:
    return aggregates.share_of_counted(t.baseline, ["admitdept"])


@question("55")
def oxygen_flow_spread(t) -> DataFrame:
    flow = numbers.to_number(F.col("oxygen_flow").cast("string"))
    return charted(t, "oxygen_flow", "admitdept").groupBy("admitdept").agg(
        numbers.round_half_up(F.var_samp(flow), 2).alias("variance"),
        numbers.round_half_up(F.stddev_samp(flow), 2).alias("standard_deviation"),
    )


@question("56")
def highest_sugar_of_low_mean(t, mean_below: float = 120) -> DataFrame:
    return aggregates.of_qualified(
        t.nursingchart, [STAY], F.avg("blood_sugar") < mean_below, {"max_blood_sugar": F.max("blood_sugar")}
    )


@question("57")
def transfers_after_disease_change(t) -> DataFrame:
    rows = windows.neighbours(
        t.transfer, [PATIENT], ["starttime", "stoptime", "transferdept", STAY],
        {"previous_stopreason": ("stopreason", 1)},
    )
    kept = rows.filter((F.col("startreason") == "Transfer") & (F.col("previous_stopreason") == "Disease change"))
    return kept.select(PATIENT, "previous_stopreason", "startreason", "transferdept").distinct()


@question("58")
def drugs_of_elderly(t, age_from: int = 65) -> DataFrame:
    counts = rows_per(t.drugs, PATIENT, out="drug_count")
    return filters.within_keys(counts, t.baseline.filter(F.col("age") >= age_from), [PATIENT]).orderBy(
        F.desc("drug_count"), PATIENT
    )


@question("59")
def always_happy(t) -> DataFrame:
    return t.outcome.filter(F.col("sf36_emotional_happyperson") == "1_All of the time").select(
        PATIENT, "sf36_emotional_happyperson"
    )


@question("60")
def discharged_in_month(t, month: int = 12) -> DataFrame:
    return t.baseline.filter(F.month("icu_discharge_time") == month).select(PATIENT, STAY)


@question("61")
def last_discharged(t, n: int = 100) -> DataFrame:
    known = t.baseline.filter(F.col("icu_discharge_time").isNotNull())
    return known.orderBy(F.desc("icu_discharge_time"), PATIENT, STAY).limit(n)


@question("63")
def twice_into_dept_in_a_day(t) -> DataFrame:
    grouped = t.transfer.groupBy(PATIENT, STAY, "transferdept", F.to_date("starttime").alias("day")).agg(
        F.count(F.lit(1)).alias("transfers")
    )
    return grouped.filter(F.col("transfers") == 2)


@question("64")
def median_temperature(t, older_than: int = 60, dept: str = "ICU") -> DataFrame:
    """Median over the distinct (patient, temperature) pairs of older patients in a department."""
    chart = charted(t, "temperature", who=(F.col("age") > older_than) & (F.col("admitdept") == dept))
    pairs = chart.filter(F.col("temperature").isNotNull()).select(PATIENT, "temperature").distinct()
    found = percentiles.median_by_rank(pairs, [], "temperature", PATIENT)
    return found.select(numbers.round_half_up(F.col("median"), 2).alias("median_temperature"))


@question("65")
def mean_sodium(t, item: str = "Sodium (NA)") -> DataFrame:
    """Mean of a lab item per patient; text that is no number is left out."""
    values = t.lab.filter((F.col("item") == item) & F.col("labvalue").isNotNull())
    joined = values.join(t.baseline.select(STAY, PATIENT), STAY)
    mean = F.avg(numbers.to_number(F.col("labvalue")))
    return joined.groupBy(PATIENT).agg(numbers.round_half_up(mean, 2).alias("average_na"))


@question("66")
def much_worse_by_dept(t) -> DataFrame:
    worse = F.col("sf36_oneyearcomparehealthcondition") == "5_Much worse now than one year ago"
    return rows_per(t.outcome.filter(worse), "discharge_dept", out="patients")


@question("67")
def repeated_pressure(t, longer_than: int = 2, by_day: bool = False) -> DataFrame:
    """Runs of one systolic value over more than two readings, or adjacent days."""
    chart = t.nursingchart.select(STAY, "charttime", "invasive_sbp")
    if by_day:
        return windows.equal_day_runs(chart, [STAY], "charttime", "invasive_sbp", longer_than)
    return windows.equal_runs(
        chart, [STAY], ["charttime", "invasive_sbp"], "invasive_sbp", longer_than, "charttime"
    )


@question("68")
def nth_youngest(t, n: int = 9) -> DataFrame:
    joined = t.outcome.select(PATIENT, "follow_vital").join(t.baseline.select(PATIENT, "age"), PATIENT)
    return ranking.nth_distinct(joined, "age", n)


@question("69")
def ventilator_bars(t, site: str = "Pneumonia", per_mark: int = 40) -> DataFrame:
    modes = charted(t, "breathing_pattern", who=F.col("infectionsite") == site)
    counts = rows_per(modes.filter(F.col("breathing_pattern").isNotNull()), "breathing_pattern", out="mode_count")
    return counts.select(
        F.rpad("breathing_pattern", 40, " ").alias("ventilator_mode"), "mode_count",
        text.text_bar(
            F.col("mode_count"), F.max("mode_count").over(Window.partitionBy()), per_mark=per_mark
        ).alias("mode_count_bar"),
    ).orderBy(F.desc("mode_count"), "ventilator_mode")


@question("70")
def checked_baseline(t, rows: DataFrame, dept: str = "ICU") -> tuple[DataFrame, DataFrame]:
    """New rows a view checked on the department accepts, and those it rejects."""
    new = rows.select(*t.baseline.columns)
    return maintenance.check_split(new, F.col("admitdept") == dept)


@question("71")
def surgery_within_days(t, days: int = 30) -> DataFrame:
    """Per discharge: admissions to surgery within 0 to 30 days after it, and the first one.

    The number of discharges with ``followers`` above 0 answers how many; the
    admissions themselves are the surgery rows the first one starts.
    """
    content = F.to_json(F.struct(*t.transfer.columns), {"ignoreNullFields": "false"})
    rows = t.transfer.distinct().withColumn("row_id", F.sha2(content, 256))
    out = rows.filter(F.col("stopreason") == "Patient pre discharge").select(
        PATIENT, STAY, "row_id", F.col("starttime").alias("discharge_time")
    )
    back = rows.filter(
        (F.col("transferdept") == "Surgery") & (F.col("stopreason") == "be hospitalized")
    ).select(PATIENT, "row_id", "starttime")
    found = joins.within_days(
        out, back, [PATIENT], "row_id", "discharge_time", "row_id", "starttime", days, include_same_time=True
    )
    return found.select(
        PATIENT, "discharge_time", F.col("next_time").alias("admission_time"), "followers",
        dates.calendar_days_between(F.col("discharge_time"), F.col("next_time")).alias("diff_in_days"),
    )


@question("72")
def alive_with_low_oxygen(t, below: float = 90) -> DataFrame:
    low = charted(t, "blood_oxygen_saturation").filter(F.col("blood_oxygen_saturation") < below)
    joined = low.join(t.outcome.filter(F.col("follow_vital").isNotNull()).select(PATIENT, "follow_vital"), PATIENT)
    share = aggregates.filtered_percent(joined, F.col("follow_vital") == "Alive", F.lit(True), "pct")
    return share.select(F.concat(F.col("pct").cast("string"), F.lit("%")).alias("pct_alive"))


@question("74")
def heart_rate_of_young(t, below: int = 40) -> DataFrame:
    chart = charted(t, "heart_rate", who=F.col("age") < below).filter(F.col("heart_rate").isNotNull())
    return chart.groupBy(PATIENT).agg(rounded_mean("heart_rate").alias("avg_heart_rate"))


@question("75")
def intubated_share(t, disease: str = "hypoproteinemia") -> DataFrame:
    """Percentage of the patients with a disease who had a tube at any depth."""
    sick = t.icd.filter(F.col("icd_desc") == disease).select(PATIENT, STAY).distinct()
    tubed = t.nursingchart.filter(F.col("endotracheal_intubation_depth").isNotNull()).select(STAY).distinct()
    flagged = sick.join(tubed.withColumn("tube", F.lit(1)), STAY, "left")
    per_patient = flagged.groupBy(PATIENT).agg(F.max("tube").alias("tube"))
    return per_patient.agg(aggregates.rate_where(F.col("tube") == 1).alias("percentage_intubated"))


@question("76")
def tube_removed(t) -> DataFrame:
    return charted(t, "extubation").filter(F.col("extubation")).select(PATIENT).distinct()


@question("77")
def diastolic_changes(t) -> DataFrame:
    column = "invasive_diastolic_blood_pressure"
    known = t.nursingchart.filter(F.col(column).isNotNull()).select(STAY, "charttime", column)
    return windows.difference(known, [STAY], ["charttime", column], column, "previous_value", "difference")


@question("78")
def long_charts(t, more_than: int = 500) -> DataFrame:
    counts = rows_per(t.nursingchart, STAY, out="entries").filter(F.col("entries") > more_than)
    return counts.join(t.baseline.select(STAY, PATIENT), STAY).orderBy(F.desc("entries"), STAY)


@question("79")
def discharges_by_month(t, dept: str = "ICU") -> DataFrame:
    when = F.col("icu_discharge_time")
    known = t.baseline.filter((F.col("admitdept") == dept) & when.isNotNull())
    return known.groupBy(
        F.date_format(when, "yyyy").alias("year"), F.date_format(when, "MM").alias("month"),
        F.date_format(when, "MMMM").alias("month_name"),
    ).agg(F.count(PATIENT).alias("patients")).orderBy("year", "month")


@question("80")
def moderate_pain_share(t) -> DataFrame:
    pain = F.col("sf36_pain_bodypainpast4wk")
    return aggregates.filtered_percent(t.outcome, pain == "4_Moderate", pain.isNotNull(), "percentage")


@question("A1")
def sexes_by_dept(t) -> DataFrame:
    return t.baseline.groupBy("admitdept").agg(
        aggregates.rate_where(F.col("sex") == "Male").alias("male_pct"),
        aggregates.rate_where(F.col("sex") == "Female").alias("female_pct"),
    )


@question("A2")
def many_different_drugs(t, more_than: int = 10) -> DataFrame:
    counts = t.drugs.groupBy(PATIENT).agg(F.count_distinct("drugname").alias("drug_count"))
    return counts.filter(F.col("drug_count") > more_than)


@question("A3")
def most_common_age(t) -> DataFrame:
    return aggregates.mode_value(t.baseline, [], "age", "most_common_age")


@question("A4")
def admitted_to(t, dept: str = "ICU") -> DataFrame:
    return t.baseline.filter(F.col("admitdept") == dept).select(PATIENT, "admitdept")


@question("A5")
def age_quartiles(t) -> DataFrame:
    people = t.baseline.select(PATIENT, STAY, "age")
    return ranking.ntile(people, [F.col("age").asc_nulls_last(), PATIENT, STAY], 4, "quartile").drop(STAY)


@question("A6")
def patients_of_dept(t) -> DataFrame:
    """Sorted patient ids of each department; a huge department continues in further parts."""
    ids = t.baseline.select("admitdept", PATIENT).distinct()
    return aggregates.group_arrays(ids, ["admitdept"], PATIENT, "patient_ids")


@question("A7")
def labs_out_of_range(t, separators: Sequence[str] = ("--", "～")) -> DataFrame:
    return numbers.outside_range(t.lab, F.col("labvalue"), F.col("reference"), separators)


@question("A8")
def excellent_but_long_in_icu(t) -> DataFrame:
    admitted = t.transfer.filter((F.col("startreason") == "Admission") & (F.col("transferdept") == "ICU"))
    stays = admitted.select(STAY, "transferdept", "starttime").join(
        t.baseline.select(STAY, PATIENT, "admitdept", "icu_discharge_time"), STAY
    )
    timed = stays.withColumn("icu_hours", hours("starttime", "icu_discharge_time"))
    long = filters.above_mean(timed, "icu_hours", "avg_icu_hours")
    excellent = t.outcome.filter(F.col("sf36_generalhealth") == "1_Excellent").select(PATIENT, "sf36_generalhealth")
    return long.join(excellent, PATIENT).select(
        PATIENT, "admitdept", "transferdept", "avg_icu_hours", "icu_hours", "sf36_generalhealth"
    ).orderBy(F.desc("icu_hours"), PATIENT)


@question("A9")
def drugs_by_age_group(t) -> DataFrame:
    age = F.col("age")
    group = (
        F.when(age.between(0, 20), "0-20").when(age.between(21, 40), "21-40")
        .when(age.between(41, 60), "41-60").otherwise("61+")
    )
    counts = t.drugs.groupBy(PATIENT).agg(F.count("drugname").alias("n"))
    joined = t.baseline.select(PATIENT, group.alias("age_group")).join(counts, PATIENT)
    return joined.groupBy("age_group").agg(F.sum("n").alias("total_drugs")).orderBy("age_group")


@question("A10")
def discharged_without_transfer(t) -> DataFrame:
    """Patients with a pre-discharge row and no transfer after their admission."""
    leaving = t.transfer.filter(F.col("startreason") == "Patient pre discharge").select(
        PATIENT, F.col("starttime").alias("discharge_time")
    )
    moved = t.transfer.filter(F.col("startreason") == "Transfer")
    stayed = filters.without_keys(leaving, moved, [PATIENT])
    return stayed.join(t.baseline.select(PATIENT, "admitdept"), PATIENT).select(
        PATIENT, "admitdept", "discharge_time"
    )


@question("A11")
def survival_by_dept(t) -> DataFrame:
    joined = t.baseline.select(PATIENT, "admitdept").join(t.outcome.select(PATIENT, "follow_vital"), PATIENT, "left")
    return aggregates.group_rate(joined, ["admitdept"], F.col("follow_vital") == "Alive", "survival_rate")


@question("A12")
def score_rank(t) -> DataFrame:
    metrics = charted(t, "blood_sugar", "heart_rate", "blood_oxygen_saturation").groupBy(PATIENT).agg(
        numbers.round_half_up(
            F.avg("blood_sugar") + F.max("heart_rate") + F.min("blood_oxygen_saturation"), 2
        ).alias("aggregated_score")
    )
    known = metrics.filter(F.col("aggregated_score").isNotNull())
    return ranking.global_rank(known, ["aggregated_score"], [True])


@question("A13")
def many_diseases_and_stay(t, more_than: int = 3, dept: str = "ICU") -> DataFrame:
    diseases = t.icd.groupBy(PATIENT).agg(F.count("icd_code").alias("disease_count"))
    many = diseases.filter(F.col("disease_count") > more_than)
    admitted = t.transfer.filter(F.col("startreason") == "Admission").select(PATIENT, "starttime")
    stays = admitted.join(t.baseline.filter(F.col("admitdept") == dept).select(PATIENT, "icu_discharge_time"), PATIENT)
    days = F.avg(dates.days_between(F.col("starttime"), F.col("icu_discharge_time")))
    mean = stays.groupBy(PATIENT).agg(numbers.round_half_up(days, 2).alias("avg_hospital_stay_days"))
    return many.join(mean, PATIENT).orderBy("disease_count", PATIENT)


@question("A14")
def common_disease_by_status(t) -> DataFrame:
    return ranking.most_frequent(t.icd, ["status_discharge"], "icd_desc", "patients_count", ties=True)


@question("A15")
def limited_patients(t) -> DataFrame:
    def limited(kind: str) -> Column:
        hit = F.col(f"sf36_activitylimit_{kind}activity") == "1_limited a lot"
        return F.count_distinct(F.when(hit, F.col(PATIENT))).alias(f"limited_{kind}")

    return t.outcome.agg(limited("vigorous"), limited("moderate"))


# Labels of the one-year comparison, with their rank and short name.
YEAR_LABELS = {
    "1_Much better now than one year ago": (1, "Much better"),
    "2_Somewhat better now than one year ago": (2, "Somewhat better"),
    "3_About the same": (3, "About the same"),
    "④比1年前差一些": (4, "Somewhat worse"),
    "5_Much worse now than one year ago": (5, "Much worse"),
}
DEPT_CODES = {"ICU": 1, "Surgery": 2, "Medical Specialties": 3}


@question("A16")
def condition_dept_correlation(t) -> DataFrame:
    condition = text.rank_of_label(
        F.col("sf36_oneyearcomparehealthcondition"), {k: rank for k, (rank, _) in YEAR_LABELS.items()}
    )
    dept = F.coalesce(text.rank_of_label(F.col("discharge_dept"), DEPT_CODES), F.lit(0))
    return t.outcome.agg(aggregates.correlation(condition, dept).alias("correlation"))


@question("A17")
def events_by_season(t) -> DataFrame:
    admitted = t.transfer.filter((F.col("startreason") == "Admission") & F.col("starttime").isNotNull())
    left = t.baseline.filter(F.col("icu_discharge_time").isNotNull())
    followed = t.outcome.filter(F.col("follow_date").isNotNull())
    return crosstabs.side_by_side(
        {
            "num_admissions": (admitted, dates.season(F.col("starttime"))),
            "num_discharges": (left, dates.season(F.col("icu_discharge_time"))),
            "num_followups": (followed, dates.season(F.col("follow_date"))),
        },
        "season",
    )


@question("A18")
def condition_by_dept(t) -> DataFrame:
    kept = t.outcome.filter(F.col("discharge_dept").isin(*DEPT_CODES))
    names = {label: short for label, (_, short) in YEAR_LABELS.items()}
    return crosstabs.crosstab(kept, ["discharge_dept"], "sf36_oneyearcomparehealthcondition", names)


@question("A19")
def rank_by_fluids(t) -> DataFrame:
    columns = {"milk": "Milk", "fruit_juice": "Fruit Juice", "soup": "Soup"}
    totals = crosstabs.unpivot_sum(t.nursingchart, [STAY], columns, "total_fluids", label=None)
    return ranking.global_rank(totals, ["total_fluids"], [True])


@question("A20")
def duplicate_transfers(t) -> DataFrame:
    return filters.sharing_duplicates(t.transfer, [PATIENT, "starttime", "stoptime", "transferdept"], STAY)


@question("A21")
def unequal_pupils(t, more_than: float = 1.0) -> DataFrame:
    left, right = (numbers.to_number(F.col(f"{side}_pupil_size")) for side in ("left", "right"))
    chart = charted(t, "charttime", "left_pupil_size", "right_pupil_size")
    sized = chart.withColumn("size_difference", F.abs(left - right))
    return sized.filter(F.col("size_difference") > more_than).drop(STAY).distinct()


@question("A22")
def icu_and_drug(t, drug: str = "Xingnaojing Injection") -> DataFrame:
    return setops.intersect(
        t.transfer.filter(F.col("transferdept") == "ICU").select(PATIENT),
        t.drugs.filter(F.col("drugname") == drug).select(PATIENT),
    )


@question("A23")
def charted_without_labs(t) -> DataFrame:
    only = setops.minus(t.nursingchart.select(STAY), t.lab.select(STAY))
    return only.join(t.baseline.select(STAY, PATIENT), STAY).select(PATIENT)
