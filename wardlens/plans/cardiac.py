"""Questions on the cardiac tables, each one a query over whole tables.

``t`` is any object whose attributes are the tables ``demography``,
``hospitalization_discharge``, ``labs``, ``cardiaccomplications``,
``patient_precriptions``, ``patienthistory`` and ``responsivenes``, keyed by
``inpatient_number``; ``registry.Tables`` reads them from a Parquet folder.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardlens.functions import dates, numbers, text
from wardlens.operators import (
    aggregates, crosstabs, filters, joins, ranking, reports, sampling, windows,
)
from wardlens.sources import inline, maintenance
from wardlens.sources.tables import as_view
from wardlens.streaming import rules

ID = "inpatient_number"
QUESTIONS: dict[str, Callable[..., DataFrame]] = {}


def question(number: str):
    """List a function under its question number (``X`` for the extra ones)."""

    def register(fn):
        QUESTIONS[number] = fn
        return fn

    return register


def count() -> Column:
    return F.count(F.lit(1)).alias("patients")


@question("1")
def with_random_age(t, seed: str = "age") -> DataFrame:
    """Patients with a whole-number age drawn within their age category."""
    return t.demography.withColumn(
        "age", sampling.random_in_text_range(F.col("agecat"), F.col(ID), seed)
    )


@question("2")
def with_birth_year(t) -> DataFrame:
    """Year of birth from the first admission; unknown for patients never admitted."""
    patients = t.demography.withColumn("yearofbirth", F.lit(None).cast("int"))
    admissions = t.hospitalization_discharge.join(t.demography.select(ID, "age"), ID)
    born = dates.birth_year(F.col("admission_date"), F.col("age")).cast("int")
    return maintenance.update_from(
        patients, admissions, [ID], "yearofbirth", born, [F.col("admission_date").asc_nulls_last()]
    )


@question("3")
def ages(t, as_of_year: int) -> DataFrame:
    born = with_birth_year(t)
    return born.select(ID, dates.years_since(F.col("yearofbirth"), as_of_year).alias("age_years"))


@question("4")
def gender_share(t) -> DataFrame:
    shares = aggregates.share_of_total(t.demography, ["gender"], F.col("gender").isNotNull(), digits=0)
    return shares.select("gender", F.concat(F.col("pct").cast("int").cast("string"), F.lit("%")).alias("pct"))


@question("5")
def with_occupation(t, occupation: str = "farmer") -> DataFrame:
    return t.demography.filter(F.col("occupation") == occupation).groupBy("occupation").agg(count())


@question("6")
def by_age_category(t) -> DataFrame:
    known = t.demography.filter(F.col("agecat").isNotNull())
    return known.groupBy("agecat").agg(count()).orderBy("agecat")


@question("7")
@question("X1")
def bmi_slabs(t, width: int = 5) -> DataFrame:
    """Patients per half-open BMI slab of equal width."""
    known = t.demography.filter(F.col("bmi").isNotNull())
    slabs = crosstabs.band_counts(known, numbers.band(F.col("bmi"), width), "slab")
    return slabs.select(
        (F.col("slab") * width).alias("bmi_from"), ((F.col("slab") + 1) * width).alias("bmi_below"), "n"
    )


@question("8")
def share_older_than(t, years: int = 70) -> DataFrame:
    return t.demography.agg(
        aggregates.count_where(F.col("age") > years).alias("patients"),
        aggregates.rate_where(F.col("age") > years, 0).alias("pct"),
    )


@question("9")
def least_readmitted_age_group(t) -> DataFrame:
    """The age category with the lowest 28-day readmission rate."""
    joined = t.hospitalization_discharge.join(t.demography.select(ID, "agecat"), ID)
    rates = aggregates.group_rate(joined, ["agecat"], F.col("re_admission_within_28_days") == 1)
    return rates.orderBy("rate", "agecat").limit(1)


@question("10")
def with_serial_number(t) -> DataFrame:
    return ranking.surrogate_key(t.demography, [ID], "sno")


@question("11")
def mean_readmission_days(t, gender: str = "Male") -> DataFrame:
    joined = t.hospitalization_discharge.join(t.demography.filter(F.col("gender") == gender).select(ID), ID)
    return joined.agg(F.round(F.avg("readmission_time_days_from_admission")).alias("days"))


# Wording of the functional classes.
NYHA = {
    1: "Class I: No symptoms of heart failure",
    2: "Class II: Symptoms of heart failure with moderate exertion",
    3: "Class III: Symptoms of heart failure with minimal exertion",
}


@question("12")
def common_failure_by_class(t) -> DataFrame:
    """The most common type of heart failure of each functional class 1 to 3."""
    grade = F.col("nyha_cardiac_function_classification")
    known = t.cardiaccomplications.filter(grade.isin(*NYHA) & F.col("type_of_heart_failure").isNotNull())
    best = ranking.most_frequent(known, ["nyha_cardiac_function_classification"], "type_of_heart_failure")
    label = F.lit(None).cast("string")
    for number, words in NYHA.items():
        label = F.when(grade == number, words).otherwise(label)
    return best.withColumn("class", label)


def _up_to(x: float) -> float:
    """The open upper end of a band that includes x."""
    return math.nextafter(x, math.inf)


# Points per echocardiography band (from, below, points).
ECHO_BANDS: dict[str, Sequence[tuple]] = {
    "myocardial_infarction": [(1, _up_to(1), 3)],
    "lvef": [(None, 30, 3), (30, _up_to(39), 2), (40, _up_to(49), 1)],
    "left_ventricular_end_diastolic_diameter_lv": [(37, _up_to(56), 1), (57, _up_to(65), 2), (_up_to(65), None, 3)],
    "mitral_valve_ems": [(0.6, _up_to(0.9), 1), (1.0, _up_to(1.5), 2), (_up_to(1.5), None, 3)],
    "mitral_valve_ams": [(None, 0.05, 3), (0.09, 0.12, 1), (0.05, 0.09, 2)],
    "ea": [(None, 0.4, 3), (0.8, _up_to(0.8), 1), (0.4, 0.8, 2)],
    "tricuspid_valve_return_velocity": [(2.9, _up_to(3.1), 1), (3.2, _up_to(3.4), 2), (3.5, None, 3)],
    "tricuspid_valve_return_pressure": [(26, _up_to(50), 1), (51, _up_to(70), 2), (_up_to(70), None, 3)],
}


@question("13")
def with_severity(t) -> DataFrame:
    """Echocardiography severity score, the points of eight measures added up."""
    total = F.lit(0)
    for column, bands in ECHO_BANDS.items():
        total = total + numbers.score(F.col(column), bands)
    return t.cardiaccomplications.withColumn("severity_score", total)


@question("14")
def mean_height_cm(t, gender: str = "Female") -> DataFrame:
    people = t.demography.filter(F.col("gender") == gender)
    return people.agg(F.round(F.avg("height") * 100).alias("height_cm"))


@question("15")
def outcome_severity_correlation(t) -> DataFrame:
    joined = t.hospitalization_discharge.join(with_severity(t).select(ID, "severity_score"), ID)
    outcome, score = F.col("outcome_during_hospitalization"), F.col("severity_score")
    pairs = {
        name: (F.when(outcome == name, 1).otherwise(0), score)
        for name in ("Dead", "Alive", "DischargeAgainstOrder")
    }
    return aggregates.correlations(joined, [], pairs, "outcome")


@question("16")
def admissions_per_day(t, start: str = "2017-03-01", stop: str = "2017-04-01") -> DataFrame:
    """Patients per recorded day of a month and the days since the recorded day before."""
    month = t.hospitalization_discharge.filter(filters.date_range("admission_date", start, stop))
    daily = windows.period_counts(month, F.to_date("admission_date"), "day", "patients")
    gaps = windows.over_periods(daily, "day", before=F.lag("day", 1))
    return gaps.select("day", "patients", F.datediff("day", "before").alias("days_since")).orderBy("day")


@question("17")
def heart_conditions(t) -> DataFrame:
    """The named view of patients with at least one pre-existing heart condition."""
    conditions = ["myocardial_infarction", "congestive_heart_failure", "peripheral_vascular_disease"]
    any_of = F.greatest(*[F.coalesce(F.col(c), F.lit(0)) for c in conditions]) == 1
    joined = t.demography.join(t.cardiaccomplications.filter(any_of), ID)
    return as_view(joined.select(ID, "gender", "age", *conditions), "patient_heart_conditions")


@question("18")
def patients_per_drug_prefix(t, prefixes: Sequence[str]) -> DataFrame:
    return reports.distinct_by_prefix(t.patient_precriptions, "drug_name", prefixes, ID, "patients")


@question("19")
def second_word_of_drugs(t) -> DataFrame:
    names = t.patient_precriptions.select("drug_name").distinct()
    return names.withColumn("second_string", text.nth_part(F.col("drug_name"), " ", 2))


@question("20")
def drugs_like(t, first: str = "E", inside: str = "x") -> DataFrame:
    name = F.col("drug_name")
    return t.patient_precriptions.filter(name.startswith(first) & name.contains(inside)).select("drug_name").distinct()


@question("21")
def readmissions_by_ward(t) -> DataFrame:
    measures = {
        "28Days": F.col("re_admission_within_28_days") == 1,
        "90Days": F.col("re_admission_within_3_months") == 1,
        "180Days": F.col("re_admission_within_6_months") == 1,
        "DWithin6months": F.col("death_within_6_months") == 1,
    }
    wards = {w: w for w in ("Cardiology", "ICU", "GeneralWard", "Others")}
    return crosstabs.measures_by_category(
        t.hospitalization_discharge, measures, "admission_ward", wards, "admission_time"
    )


@question("23")
def admission_span_days(t) -> DataFrame:
    when = "admission_date"
    return t.hospitalization_discharge.agg(
        dates.calendar_days_between(F.min(when), F.max(when)).alias("total_days")
    )


@question("24")
def days_per_visit_by_series(t) -> DataFrame:
    """Discharge day over visit times by counting a series; NULL for no visits."""
    visits = F.when(F.col("visit_times") > 0, F.col("visit_times"))
    return t.hospitalization_discharge.select(
        ID, "dischargeday", "visit_times",
        inline.series_quotient(F.lit(0), F.col("dischargeday"), visits).alias("quotient"),
    )


@question("X10")
def days_per_visit_by_division(t) -> DataFrame:
    visits = F.nullif(F.col("visit_times"), F.lit(0))
    return t.hospitalization_discharge.select(
        ID, "dischargeday", "visit_times",
        numbers.whole_quotient(F.col("dischargeday"), visits).alias("quotient"),
    )


@question("25")
def patients_by_way_letter(t) -> DataFrame:
    letter = F.substring("admission_way", 1, 1).alias("first_letter")
    return t.hospitalization_discharge.groupBy(letter).agg(F.count_distinct(ID).alias("patients"))


@question("26")
def personal_markers(t) -> DataFrame:
    joined = t.labs.join(t.demography, ID)
    markers = numbers.text_array(
        F.col("gender"), F.col("bmi").cast("decimal(38,2)"), F.col("pulse").cast("decimal(38,2)"),
        F.col("map_value").cast("decimal(38,0)"),
    )
    return joined.select(ID, markers.alias("personal_markers"))


@question("27")
def hydro_drugs(t) -> DataFrame:
    names = t.patient_precriptions.filter(F.col("drug_name").contains("hydro")).select("drug_name").distinct()
    return names.withColumn("new_drug_name", text.relabel_if_contains(F.col("drug_name"), "hydro", "H2O"))


@question("29")
def cancer_patients(t) -> DataFrame:
    cancer = (F.col("leukemia") == 1) | (F.col("malignant_lymphoma") == 1)
    return t.patienthistory.filter(cancer).agg(F.count_distinct(ID).alias("patients"))


@question("30")
def admissions_moving_mean(t) -> DataFrame:
    months = windows.period_counts(
        t.hospitalization_discharge, dates.month_start(F.col("admission_date")), "month", "admissions"
    )
    moved = windows.moving_mean(months, "month", "admissions", 3, "moving")
    return moved.withColumn("moving", numbers.round_half_up(F.col("moving"), 2)).orderBy("month")


@question("31")
def oxygen_and_fast_breathing(t, start: str = "2017-02-01", stop: str = "2017-03-01") -> DataFrame:
    stays = t.hospitalization_discharge.filter(
        (F.col("oxygen_inhalation") == "OxygenTherapy") & filters.date_range("admission_date", start, stop)
    )
    return t.labs.filter(F.col("respiration") > 20).join(stays.select(ID), ID).select(ID)


@question("32")
def highest_pressure_and_pulse(t, kind: str = "Both") -> DataFrame:
    of_kind = t.cardiaccomplications.filter(F.col("type_of_heart_failure") == kind)
    joined = t.labs.join(of_kind.select(ID, "type_of_heart_failure"), ID)
    return joined.groupBy(ID, "type_of_heart_failure").agg(
        numbers.round_half_up(F.max("map_value"), 2).alias("high_map"), F.max("pulse").alias("high_pulse")
    ).orderBy(F.desc_nulls_last("high_map"), F.desc_nulls_last("high_pulse"), ID)


def age_decade(age: Column) -> Column:
    """0-10, 11-20, ... 71-80, 81+."""
    upper = F.greatest(F.ceil(age / 10) * 10, F.lit(10).cast("bigint"))
    low = F.when(upper == 10, F.lit(0).cast("bigint")).otherwise(upper - 9)
    return F.when(age <= 80, F.concat_ws("-", low.cast("string"), upper.cast("string"))).otherwise("81+")


@question("34")
def monocytes_by_age(t) -> DataFrame:
    joined = t.labs.join(t.demography.select(ID, "age"), ID)
    mean = F.avg("monocyte_ratio") * 100
    return joined.groupBy(age_decade(F.col("age")).alias("age_group")).agg(mean.alias("avg_monocyte_pct"))


@question("35")
def pressure_family(parent: DataFrame, child: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows to the child table and scan parent and child together."""
    return maintenance.family_scan(parent, maintenance.append_rows(child, rows))


@question("37")
def ward_share(t) -> DataFrame:
    return reports.group_percentage(t.hospitalization_discharge, "admission_ward")


@question("38")
def comorbidity_parity(t, n: int = 10, seed: str = "parity") -> DataFrame:
    few = sampling.random_rows(t.patienthistory, [ID], n, seed)
    score = F.rint("cci_score").cast("int")
    return few.select(ID, "cci_score", numbers.parity_label(score).alias("even_odd"))


@question("39")
def months_side_by_side(t) -> DataFrame:
    months = windows.period_counts(t.hospitalization_discharge, F.month("admission_date"), "month", "current")
    return windows.over_periods(
        months, "month", previous=F.lag("current", 1, 0), next=F.lead("current", 1, 0)
    ).orderBy("month")


@question("40")
def patient_details(t) -> DataFrame:
    """Comma-separated details of every patient present in all five tables."""
    return reports.entity_csv(
        t.demography.select(ID, "age"),
        [
            t.labs.select(ID, "white_blood_cell"),
            t.responsivenes.select(ID, "consciousness"),
            t.cardiaccomplications.select(ID, "killip_grade"),
            t.patienthistory.select(ID, "diabetes"),
        ],
        ID,
        [F.col(c) for c in (ID, "age", "white_blood_cell", "killip_grade", "consciousness", "diabetes")],
        how="inner",
    )


@question("41")
def many_drugs(t, more_than: int = 15) -> DataFrame:
    counts = t.patient_precriptions.groupBy(ID).agg(F.count("drug_name").alias("drug_count"))
    return (
        counts.filter(F.col("drug_count") > more_than)
        .join(t.demography.select(ID, "age"), ID)
        .join(t.hospitalization_discharge.select(ID, "outcome_during_hospitalization"), ID)
    )


@question("42")
def find_patients(t, requested: DataFrame) -> DataFrame:
    """Requested patients with a found flag and their gender."""
    flagged = filters.exists_flag(requested.select(ID), t.demography, [ID])
    return flagged.join(t.demography.select(ID, "gender"), ID, "left")


@question("43")
def random_failure_types(t, n: int = 10, seed: str = "types") -> DataFrame:
    return sampling.random_rows(t.cardiaccomplications, [ID], n, seed).select(ID, "type_of_heart_failure")


@question("44")
def long_drug_names(t, longer_than: int = 20) -> DataFrame:
    long = t.patient_precriptions.filter(F.char_length("drug_name") > longer_than)
    return long.agg(F.count_distinct("drug_name").alias("names"))


COMORBIDITIES = (
    "cerebrovascular_disease", "dementia", "chronic_obstructive_pulmonary_disease",
    "connective_tissue_disease", "peptic_ulcer_disease", "diabetes",
    "moderate_to_severe_chronic_kidney_disease", "hemiplegia", "leukemia", "malignant_lymphoma",
    "solid_tumor", "liver_disease", "aids",
)


@question("45")
def comorbidity_rank(t) -> DataFrame:
    found = numbers.flag_sum(*[F.col(c) for c in COMORBIDITIES])
    scored = t.patienthistory.filter(F.col("cci_score").isNotNull()).select(
        ID, "cci_score", found.alias("num_comorbidities")
    )
    return ranking.global_rank(scored, ["cci_score", "num_comorbidities"], [True, True])


@question("46")
def sound_to_pain_ratio(t) -> DataFrame:
    state = F.col("consciousness")
    ratio = aggregates.count_ratio(state == "ResponsiveToSound", state == "ResponsiveToPain")
    return t.responsivenes.agg(ratio.alias("sound_pain_ratio"))


@question("47")
def highest_pressure_by_way(t) -> DataFrame:
    joined = (
        t.hospitalization_discharge.select(ID, "admission_way")
        .join(t.demography.select(ID, "occupation"), ID)
        .join(t.labs.select(ID, "map_value"), ID)
    )
    best = ranking.top_values(joined, ["admission_way"], "map_value")
    return best.select("admission_way", "occupation", "map_value").distinct()


@question("48")
def highest_bmi(t) -> DataFrame:
    return filters.equals_extreme(t.demography, "bmi").select(ID, "bmi")


@question("49")
def leukopenia(t, below: float = 3.0e9) -> DataFrame:
    return t.labs.filter(F.col("white_blood_cell") < below).select(ID, "white_blood_cell").orderBy(
        F.desc("white_blood_cell"), ID
    )


@question("50")
def busiest_weekday(t) -> DataFrame:
    days = t.hospitalization_discharge.select(dates.weekday_name(F.col("admission_date")).alias("weekday"))
    return ranking.most_frequent(days.filter(F.col("weekday").isNotNull()), [], "weekday")


@question("51")
def age_category_bars(t, more_than: int = 100, per_mark: int = 40) -> DataFrame:
    counts = t.demography.groupBy("agecat").agg(count()).filter(F.col("patients") > more_than)
    return counts.withColumn("bar", text.text_bar(
        F.col("patients"), F.max("patients").over(Window.partitionBy()), per_mark=per_mark
    )).orderBy("patients", "agecat")


@question("52")
def d_dimer_spread(t) -> DataFrame:
    """Variance of D-dimer over all patients with its covariance and correlation to CCI."""
    joined = t.labs.filter(F.col("d_dimer").isNotNull()).join(t.patienthistory.select(ID, "cci_score"), ID)
    dimer, score = F.col("d_dimer"), F.col("cci_score")
    return joined.agg(
        F.var_pop(dimer).alias("variance"), F.covar_pop(dimer, score).alias("covariance"),
        aggregates.correlation(dimer, score).alias("correlation"),
    )


@question("53")
def lowest_death_rate_ward(t, n: int = 3) -> DataFrame:
    rates = aggregates.group_rate(
        t.hospitalization_discharge, ["admission_ward"], F.col("outcome_during_hospitalization") == "Dead"
    )
    return rates.orderBy("rate", "admission_ward").limit(n)


@question("54")
def coma_with_diabetes(t, coma_at_most: int = 8) -> DataFrame:
    coma = t.responsivenes.filter(F.col("gcs") <= coma_at_most)
    patients = filters.within_keys(t.patienthistory, coma, [ID])
    return patients.agg(
        count(), aggregates.count_where(F.col("diabetes") == 1).alias("with_diabetes"),
        aggregates.rate_where(F.col("diabetes") == 1).alias("pct"),
    )


@question("55")
def drugs_of_youngest(t) -> DataFrame:
    youngest = t.demography.filter(F.col("age").isNotNull()).orderBy("age", ID).limit(1)
    return filters.within_keys(t.patient_precriptions, youngest, [ID]).select(ID, "drug_name")


@question("56")
def checked_responses(t, rule: Column) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows of a checked view on the responses."""
    return maintenance.check_split(t.responsivenes, rule)


@question("57")
def palindromes(words: DataFrame, column: str = "word") -> DataFrame:
    return words.select(column, text.is_palindrome(F.col(column)).alias("palindrome"))


@question("58")
def common_visits_of_readmitted(t) -> DataFrame:
    readmitted = t.hospitalization_discharge.filter(F.col("re_admission_within_6_months") == 1)
    return ranking.most_frequent(readmitted, [], "visit_times", "patients")


@question("61")
def readmission_by_destination(t, high_above: float = 7.0) -> DataFrame:
    """Distinct readmitted patients per destination, labelled by a threshold percentage."""
    readmitted = F.when(F.col("re_admission_within_28_days") == 1, F.col(ID))
    grouped = t.hospitalization_discharge.groupBy("destinationdischarge").agg(
        F.count_distinct(ID).alias("total_patients"), F.count_distinct(readmitted).alias("readmitted")
    )
    exact = F.try_divide(F.col("readmitted") * 100.0, F.col("total_patients"))
    label = F.when(exact > high_above, "high rate of readmission").otherwise("low rate of readmission")
    return grouped.withColumn("pct", numbers.round_half_up(exact, 2)).withColumn("criteria", label)


@question("63")
def joined_demography(t) -> DataFrame:
    line = F.concat_ws(
        " ; ", F.coalesce(F.col("age"), F.lit(0)).cast("string"),
        F.coalesce("gender", F.lit("NA")), F.col(ID).cast("string"),
    )
    return t.demography.select(line.alias("concat_demography")).orderBy(F.desc("concat_demography"))


@question("64")
def reversed_drugs(t, n: int = 5) -> DataFrame:
    names = t.patient_precriptions.select("drug_name").distinct().orderBy("drug_name").limit(n)
    return names.withColumn("reversed", F.reverse("drug_name"))


@question("65")
def gcs_dispersion(t) -> DataFrame:
    return t.responsivenes.agg(aggregates.dispersion_index(F.col("gcs")).alias("variance_from_mean"))


@question("67")
def admission_months(t) -> DataFrame:
    when = F.col("admission_date")
    return t.hospitalization_discharge.select(
        when, F.date_format(when, "MM").alias("month_number"), F.date_format(when, "MMMM").alias("month_name")
    )


@question("68")
def both_failures_with_kidney_or_cancer(t) -> DataFrame:
    kidney, leukemia, lymphoma = (
        F.coalesce(F.col(c), F.lit(0))
        for c in ("moderate_to_severe_chronic_kidney_disease", "leukemia", "malignant_lymphoma")
    )
    both = t.cardiaccomplications.filter(F.col("type_of_heart_failure") == "Both").select(ID, "type_of_heart_failure")
    sick = t.patienthistory.filter((kidney == 1) | (leukemia == 1) | (lymphoma == 1))
    return sick.join(both, ID).groupBy("type_of_heart_failure").agg(
        count(), F.sum(kidney).alias("kidney"), F.sum(leukemia + lymphoma).alias("cancer")
    )


@question("69")
def occupation_lengths(t) -> DataFrame:
    stored, nominal, chars = text.bits_and_chars(F.col("occupation"))
    names = t.demography.filter(F.col("occupation").isNotNull()).select("occupation").distinct()
    return names.select("occupation", chars.alias("chars"), nominal.alias("bits"), stored.alias("stored_bits"))


@question("70")
def with_date(t, today: str) -> DataFrame:
    return maintenance.add_columns(t.cardiaccomplications, today_date=F.lit(today).cast("date"))


@question("71")
def second_bmi_of_top_myoglobin(t, top: int = 5) -> DataFrame:
    """The second-highest BMI among rows holding the highest myoglobin values."""
    joined = t.demography.select(ID, "bmi").join(
        t.labs.filter(F.col("myoglobin").isNotNull()).select(ID, "myoglobin"), ID
    )
    highest = joined.select("myoglobin").distinct().orderBy(F.desc("myoglobin")).limit(top)
    return ranking.nth_distinct(
        filters.within_keys(joined, highest, ["myoglobin"]), "bmi", 2, ascending=False
    ).select(ID, "myoglobin", "bmi")


@question("72")
def pulse_variation(t) -> DataFrame:
    return t.labs.agg(aggregates.variation(F.col("pulse")).alias("cv_pulse"))


@question("73")
def without_age(t) -> DataFrame:
    return maintenance.drop_columns(t.demography, "age")


@question("74")
def cci_by_bmi(t, split: float = 30) -> DataFrame:
    band = (
        F.when(F.col("bmi") < split, "less than 30").when(F.col("bmi") > split, "more than 30").otherwise("no bmi")
    )
    joined = t.patienthistory.join(t.demography.select(ID, "bmi"), ID)
    return joined.groupBy(band.alias("bmi_range")).agg(F.avg("cci_score").alias("avg_cci_score"))


@question("75")
def bmi_alerts(demography: DataFrame, above: float = 40) -> DataFrame:
    """Warnings for new patients; ``demography`` may be a stream."""
    return rules.only_alerts(demography, F.col("bmi") > above, "This patient has a high risk of heart risks")


@question("76")
def most_obese_group(t, obese_from: float = 30) -> DataFrame:
    obese = t.demography.filter((F.col("bmi") >= obese_from) & F.col("agecat").isNotNull() & F.col("gender").isNotNull())
    groups = obese.groupBy("agecat", "gender").agg(count(), F.max("bmi").alias("highest_bmi"))
    return groups.orderBy(F.desc("patients"), "agecat", "gender").limit(1)


@question("77")
def responses_as_json(t) -> DataFrame:
    columns = [F.col(c) for c in (ID, "eye_opening", "verbal_response", "movement", "consciousness", "gcs")]
    return t.responsivenes.select(ID, numbers.json_object(*columns).alias("response"))


@question("78")
def upper_respiratory_failure(t) -> DataFrame:
    return maintenance.add_columns(
        t.patienthistory, type_ii_respiratory_failure=F.upper("type_ii_respiratory_failure")
    )


@question("79")
def drugs_matching(t, pattern: str = "(Digoxin|Furosemide)") -> DataFrame:
    return t.patient_precriptions.filter(F.col("drug_name").rlike(f"(?i){pattern}"))


@question("80")
def linked_to_drug(t, drug: str = "Furosemide injection") -> DataFrame:
    """All prescriptions of the patients who were given the drug."""
    return joins.linked_rows(t.patient_precriptions, F.col("drug_name") == drug, [ID])


@question("X2")
def by_gender_and_age(t) -> DataFrame:
    known = t.demography.filter(F.col("agecat").isNotNull())
    return known.groupBy(F.concat("agecat", F.lit(" years")).alias("age_category")).agg(
        aggregates.count_where(F.col("gender") == "Male").alias("male"),
        aggregates.count_where(F.col("gender") == "Female").alias("female"),
    ).orderBy("age_category")


@question("X3")
def stay_by_conditions(t) -> DataFrame:
    conditions = ["diabetes", "cerebrovascular_disease", "chronic_obstructive_pulmonary_disease"]
    any_of = F.greatest(*[F.coalesce(F.col(c), F.lit(0)) for c in conditions]) == 1
    joined = (
        t.hospitalization_discharge.select(ID, "dischargeday")
        .join(t.patienthistory.filter(any_of).select(ID, *conditions), ID)
        .join(t.demography.select(ID, "agecat"), ID)
    )
    return joined.groupBy("agecat", *conditions).agg(F.round(F.avg("dischargeday")).alias("avg_stay"))


@question("X4")
def bmi_recomputed(t) -> DataFrame:
    computed = F.try_divide(F.col("weight"), F.pow("height", F.lit(2)))
    both = t.demography.filter(F.col("weight").isNotNull()).select(
        ID, "weight", "height", numbers.round_half_up(computed, 2).alias("calc_bmi"),
        numbers.round_half_up(F.col("bmi"), 2).alias("table_bmi"),
    )
    return both.withColumn("same", numbers.nearly_equal(F.col("calc_bmi"), F.col("table_bmi"), 0.005))


# Wording of the Killip grades.
KILLIP = {
    1: "1: no clinical signs of heart failure.",
    2: "2: elevated jugular venous pressure",
    3: "3: acute pulmonary edema.",
    4: "4: cardiogenic shock or hypotension",
}


@question("X5")
def by_killip_grade(t) -> DataFrame:
    label = F.lit("unknown")
    for grade, words in KILLIP.items():
        label = F.when(F.col("killip_grade") == grade, words).otherwise(label)
    graded = maintenance.add_columns(t.cardiaccomplications, killip_grade_category=label)
    return graded.groupBy("killip_grade", "killip_grade_category").agg(count()).orderBy("killip_grade")


@question("X7")
def padded_ids(t, width: int = 12) -> DataFrame:
    return t.demography.select(ID, text.zero_pad(F.col(ID), width).alias("new_inpatient_number"))


@question("X8")
def alternate_rows(t, even: bool = False) -> DataFrame:
    """Odd (or even) rows by serial number."""
    rows = with_serial_number(t)
    return rows.filter(numbers.is_even(F.col("sno")) == F.lit(even))


@question("X9")
def gcs_skewness(t) -> DataFrame:
    return aggregates.skewness(t.responsivenes, "gcs").withColumn("skew", numbers.round_half_up(F.col("skew"), 2))
