"""Cardiac questions against brute force over the fixture rows."""

import inspect
import statistics as st
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import clinic
from wardlens.plans import cardiac as q

ID = "inpatient_number"


@pytest.fixture(scope="module")
def rows():
    return clinic.cardiac_rows()


@pytest.fixture(scope="module")
def t(spark, rows, tmp_path_factory):
    return clinic.tables(spark, clinic.CARDIAC, rows, str(tmp_path_factory.mktemp("cardiac")))


@pytest.fixture(scope="module")
def d(rows):
    """Rows of each table by patient (prescriptions stay a list)."""
    return {n: {r[ID]: r for r in rs} for n, rs in rows.items() if n != "patient_precriptions"}


def got(df):
    return [tuple(r) for r in df.collect()]


def same(df, want):
    assert sorted(map(repr, got(df))) == sorted(map(repr, want))


def test_all_built_questions_are_listed():
    main = set(range(1, 81)) - {22, 28, 33, 36, 59, 60, 62, 66}
    extra = {1, 2, 3, 4, 5, 7, 8, 9, 10}
    assert set(q.QUESTIONS) == {str(n) for n in main} | {f"X{n}" for n in extra}


def test_every_question_over_tables_alone_runs(t):
    for number, fn in q.QUESTIONS.items():
        needed = [p for p in inspect.signature(fn).parameters.values() if p.default is p.empty]
        if [p.name for p in needed] == ["t"]:
            assert fn(t).columns and fn(t).count() >= 0, number


def test_q1_q2_q3_ages(t, d):
    for r in q.with_random_age(t).collect():
        if r["agecat"]:
            low, high = map(int, r["agecat"].split("-"))
            assert low <= r["age"] <= high
        else:
            assert r["age"] is None
    born = {r[ID]: r["yearofbirth"] for r in q.with_birth_year(t).collect()}
    assert born == {i: None if p["age"] is None else 2017 - p["age"] for i, p in d["demography"].items()}
    ages = {r[ID]: r["age_years"] for r in q.ages(t, 2024).collect()}
    assert ages == {i: None if p["age"] is None else p["age"] + 7 for i, p in d["demography"].items()}


def test_q4_to_q8_counts(t, rows):
    people = rows["demography"]
    sexes = Counter(p["gender"] for p in people if p["gender"])
    same(q.gender_share(t), [(g, f"{int(n * 100 / 60 + 0.5)}%") for g, n in sexes.items()])
    same(q.with_occupation(t), [("farmer", sum(p["occupation"] == "farmer" for p in people))])
    same(q.by_age_category(t), Counter(p["agecat"] for p in people if p["agecat"]).items())
    slabs = Counter(int(p["bmi"] // 5) for p in people if p["bmi"] is not None)
    same(q.bmi_slabs(t), [(5 * s, 5 * s + 5, n) for s, n in slabs.items()])
    old = sum(p["age"] is not None and p["age"] > 70 for p in people)
    same(q.share_older_than(t), [(old, float(int(old * 100 / 60 + 0.5)))])


def test_q9_q11_q14(t, d):
    groups = defaultdict(list)
    for i, h in d["hospitalization_discharge"].items():
        groups[d["demography"][i]["agecat"]].append(h["re_admission_within_28_days"])
    rates = {g: round(100 * sum(v) / len(v), 2) for g, v in groups.items()}
    best = min(rates, key=lambda g: (rates[g], g or ""))
    assert q.least_readmitted_age_group(t).first()["agecat"] == best
    men = [h["readmission_time_days_from_admission"] for i, h in d["hospitalization_discharge"].items()
           if d["demography"][i]["gender"] == "Male" and h["readmission_time_days_from_admission"] is not None]
    assert q.mean_readmission_days(t).first()["days"] == int(st.mean(men) + 0.5)
    women = [p["height"] for p in d["demography"].values() if p["gender"] == "Female"]
    assert q.mean_height_cm(t).first()["height_cm"] == int(st.mean(women) * 100 + 0.5)


def test_q12_common_failure(t, rows):
    counts = Counter((c["nyha_cardiac_function_classification"], c["type_of_heart_failure"])
                     for c in rows["cardiaccomplications"])
    for r in q.common_failure_by_class(t).collect():
        grade = r["nyha_cardiac_function_classification"]
        assert grade in (2, 3) and r["class"] == q.NYHA[grade]
        assert r["n"] == max(n for (g, _), n in counts.items() if g == grade)


def points(c):
    def bands(x, *rules):
        return 0 if x is None else next((p for test, p in rules if test(x)), 0)

    return (
        3 * (c["myocardial_infarction"] == 1)
        + bands(c["lvef"], (lambda x: 50 <= x <= 70, 0), (lambda x: 40 <= x <= 49, 1), (lambda x: 30 <= x <= 39, 2), (lambda x: x < 30, 3))
        + bands(c["left_ventricular_end_diastolic_diameter_lv"], (lambda x: 37 <= x <= 56, 1), (lambda x: 57 <= x <= 65, 2), (lambda x: x > 65, 3))
        + bands(c["mitral_valve_ems"], (lambda x: 0.6 <= x <= 0.9, 1), (lambda x: 1.0 <= x <= 1.5, 2), (lambda x: x > 1.5, 3))
        + bands(c["mitral_valve_ams"], (lambda x: x >= 0.12, 0), (lambda x: 0.09 <= x, 1), (lambda x: 0.05 <= x, 2), (lambda x: True, 3))
        + bands(c["ea"], (lambda x: x > 0.8, 0), (lambda x: x == 0.8, 1), (lambda x: x >= 0.4, 2), (lambda x: True, 3))
        + bands(c["tricuspid_valve_return_velocity"], (lambda x: 2.9 <= x <= 3.1, 1), (lambda x: 3.2 <= x <= 3.4, 2), (lambda x: x >= 3.5, 3))
        + bands(c["tricuspid_valve_return_pressure"], (lambda x: 26 <= x <= 50, 1), (lambda x: 51 <= x <= 70, 2), (lambda x: x > 70, 3))
    )


def test_q13_q15_severity(t, d):
    scores = {r[ID]: r["severity_score"] for r in q.with_severity(t).collect()}
    assert scores == {i: points(c) for i, c in d["cardiaccomplications"].items()}
    for r in q.outcome_severity_correlation(t).collect():
        xs = [scores[i] for i in scores]
        ys = [float(d["hospitalization_discharge"][i]["outcome_during_hospitalization"] == r["outcome"]) for i in scores]
        assert r["correlation"] == pytest.approx(st.correlation(ys, xs))


def test_q16_q30_q39_periods(t, rows):
    stays = [h["admission_date"] for h in rows["hospitalization_discharge"]]
    march = sorted(Counter(a.date() for a in stays if a.month == 3).items())
    gaps = [None] + [(b[0] - a[0]).days for a, b in zip(march, march[1:])]
    assert got(q.admissions_per_day(t)) == [(day, n, g) for (day, n), g in zip(march, gaps)]
    months = sorted(Counter(a.month for a in stays).items())
    moving = [r["moving"] for r in q.admissions_moving_mean(t).collect()]
    assert moving == [round(st.mean(n for _, n in months[max(0, k - 2):k + 1]) + 1e-9, 2) for k in range(len(months))]
    counts = [n for _, n in months]
    want = [(m, n, counts[k - 1] if k else 0, counts[k + 1] if k + 1 < len(counts) else 0) for k, (m, n) in enumerate(months)]
    assert [(r["month"], r["current"], r["previous"], r["next"]) for r in q.months_side_by_side(t).collect()] == want


def test_q17_to_q20_drugs_and_view(t, rows, d):
    names = [p["drug_name"] for p in rows["patient_precriptions"]]
    prefixes = ["Asp", "Dig", "dig", "Zz"]
    want = [(x, len({p[ID] for p in rows["patient_precriptions"] if p["drug_name"].startswith(x)})) for x in prefixes]
    same(q.patients_per_drug_prefix(t, prefixes), want)
    same(q.second_word_of_drugs(t), {(n, (n.split(" ") + [""])[1]) for n in names})
    same(q.drugs_like(t), {(n,) for n in names if n[0] == "E" and "x" in n})
    sick = {i for i, c in d["cardiaccomplications"].items()
            if 1 in (c["myocardial_infarction"], c["congestive_heart_failure"], c["peripheral_vascular_disease"])}
    assert {r[ID] for r in q.heart_conditions(t).collect()} == sick


def test_q21_q25_q37_wards(t, rows):
    stays = rows["hospitalization_discharge"]
    wards = ["Cardiology", "ICU", "GeneralWard", "Others"]
    columns = {"28Days": "re_admission_within_28_days", "90Days": "re_admission_within_3_months",
               "180Days": "re_admission_within_6_months", "DWithin6months": "death_within_6_months"}
    want = [(n, *[sum(s[c] for s in stays if s["admission_ward"] == w) for w in wards]) for n, c in columns.items()]
    same(q.readmissions_by_ward(t), want)
    letters = defaultdict(set)
    for s in stays:
        letters[s["admission_way"][0]].add(s[ID])
    same(q.patients_by_way_letter(t), [(k, len(v)) for k, v in letters.items()])
    share = {r["admission_ward"]: r["pct"] for r in q.ward_share(t).collect()}
    for w, n in Counter(s["admission_ward"] for s in stays).items():
        assert share[w] == pytest.approx(round(100 * n / 60, 2))


def test_q23_q24_q10x_q67(t, rows):
    stays = rows["hospitalization_discharge"]
    days = [s["admission_date"].date() for s in stays]
    same(q.admission_span_days(t), [((max(days) - min(days)).days,)])
    want = [(s[ID], s["dischargeday"], s["visit_times"],
             s["dischargeday"] // s["visit_times"] if s["visit_times"] else None) for s in stays]
    same(q.days_per_visit_by_division(t), want)
    same(q.days_per_visit_by_series(t), want)
    assert {(r["month_number"], r["month_name"]) for r in q.admission_months(t).collect()} == {
        (f"{a.month:02}", a.strftime("%B")) for a in days}


def test_q29_q31_q44_q49(t, rows, d):
    assert q.cancer_patients(t).first()[0] == sum(1 in (h["leukemia"], h["malignant_lymphoma"]) for h in rows["patienthistory"])
    want = [(i,) for i, x in d["labs"].items() if x["respiration"] > 20
            and d["hospitalization_discharge"][i]["oxygen_inhalation"] == "OxygenTherapy"
            and d["hospitalization_discharge"][i]["admission_date"].month == 2]
    same(q.oxygen_and_fast_breathing(t), want)
    assert q.long_drug_names(t).first()[0] == len({p["drug_name"] for p in rows["patient_precriptions"] if len(p["drug_name"]) > 20})
    same(q.leukopenia(t), [(i, x["white_blood_cell"]) for i, x in d["labs"].items() if x["white_blood_cell"] < 3e9])


def test_q34_age_decades(spark):
    ages = spark.createDataFrame([(0,), (10,), (11,), (20,), (21,), (80,), (81,), (None,)], "a int")
    labels = [r[0] for r in ages.select(q.age_decade(F.col("a"))).collect()]
    assert labels == ["0-10", "0-10", "11-20", "11-20", "21-30", "71-80", "81+", "81+"]


def test_q35_inheritance(spark):
    parent = spark.createDataFrame([(1, "M")], "inpatient_number int, gender string")
    child = spark.createDataFrame([], "inpatient_number int, gender string, systolic int, diastolic int")
    new = spark.createDataFrame([(2011, "F", 120)], "inpatient_number int, gender string, systolic int")
    same(q.pressure_family(parent, child, new), [(1, "M", None, None), (2011, "F", 120, None)])


def test_q38_parity(t, d):
    out = q.comorbidity_parity(t, 20).collect()
    assert len(out) == 20 and out == q.comorbidity_parity(t, 20).collect()
    for r in out:
        s = d["patienthistory"][r[ID]]["cci_score"]
        assert r["even_odd"] == ("Null" if s is None else "Odd" if s % 2 else "Even")


def test_q40_q41_q42_q77(spark, t, rows, d):
    lines = dict(got(q.patient_details(t)))
    assert set(lines) == set(d["responsivenes"])
    assert all(v.count(", ") == 5 for v in lines.values())
    no_age = [i for i in lines if d["demography"][i]["age"] is None]
    assert all(lines[i].startswith(f"{i}, N/A, ") for i in no_age)
    counts = Counter(p[ID] for p in rows["patient_precriptions"])
    assert {(r[ID], r["drug_count"]) for r in q.many_drugs(t).collect()} == {(i, n) for i, n in counts.items() if n > 15}
    asked = spark.createDataFrame([(1,), (999,)], "inpatient_number long")
    same(q.find_patients(t, asked), [(1, True, d["demography"][1]["gender"]), (999, False, None)])
    assert any('"movement":null' in r["response"] for r in q.responses_as_json(t).collect())


def test_q45_q46_q65_q72_x9(t, rows):
    scored = [(h["cci_score"], sum(h[c] or 0 for c in q.COMORBIDITIES), h[ID])
              for h in rows["patienthistory"] if h["cci_score"] is not None]
    want = {i: 1 + sum((a, b) > (s, n) for a, b, _ in scored) for s, n, i in scored}
    assert {r[ID]: r["rank"] for r in q.comorbidity_rank(t).collect()} == want
    states = Counter(r["consciousness"] for r in rows["responsivenes"])
    assert q.sound_to_pain_ratio(t).first()[0] == states["ResponsiveToSound"] / states["ResponsiveToPain"]
    gcs = [r["gcs"] for r in rows["responsivenes"]]
    assert q.gcs_dispersion(t).first()[0] == pytest.approx(st.variance(gcs) / st.mean(gcs))
    pulse = [r["pulse"] for r in rows["labs"]]
    assert q.pulse_variation(t).first()[0] == pytest.approx(st.stdev(pulse) / st.mean(pulse))
    skew = q.gcs_skewness(t).first()
    assert skew["median"] == st.median(gcs)
    assert skew["skew"] == pytest.approx(3 * (st.mean(gcs) - st.median(gcs)) / st.stdev(gcs), abs=0.0051)


def test_q32_q47_q48_q71_extremes(t, d):
    both = [i for i, c in d["cardiaccomplications"].items() if c["type_of_heart_failure"] == "Both"]
    assert {(r[ID], r["high_map"]) for r in q.highest_pressure_and_pulse(t).collect()} == {
        (i, d["labs"][i]["map_value"]) for i in both}
    ways = defaultdict(set)
    for i, h in d["hospitalization_discharge"].items():
        if d["labs"][i]["map_value"] is not None:
            ways[h["admission_way"]].add((d["labs"][i]["map_value"], d["demography"][i]["occupation"]))
    want = [(w, occ, m) for w, s in ways.items() for m, occ in s if m == max(s, key=lambda x: x[0])[0]]
    same(q.highest_pressure_by_way(t), want)
    top = max(p["bmi"] for p in d["demography"].values() if p["bmi"] is not None)
    same(q.highest_bmi(t), [(i, p["bmi"]) for i, p in d["demography"].items() if p["bmi"] == top])
    values = sorted({x["myoglobin"] for x in d["labs"].values() if x["myoglobin"]}, reverse=True)[:5]
    holders = [i for i, x in d["labs"].items() if x["myoglobin"] in values]
    second = sorted({d["demography"][i]["bmi"] for i in holders if d["demography"][i]["bmi"] is not None})[-2]
    assert {r["bmi"] for r in q.second_bmi_of_top_myoglobin(t).collect()} == {second}


def test_q50_q51_q58_frequencies(t, rows):
    days = Counter(h["admission_date"].strftime("%A") for h in rows["hospitalization_discharge"])
    assert got(q.busiest_weekday(t)) == [min(days.items(), key=lambda x: (-x[1], x[0]))]
    bars = {r["agecat"]: r["bar"] for r in q.age_category_bars(t, 5, 4).collect()}
    assert bars == {a: "▰" * (n // 4) for a, n in Counter(p["agecat"] for p in rows["demography"]).items() if n > 5}
    visits = Counter(h["visit_times"] for h in rows["hospitalization_discharge"] if h["re_admission_within_6_months"])
    assert got(q.common_visits_of_readmitted(t)) == [min(visits.items(), key=lambda x: (-x[1], x[0]))]


def test_q52_q53_q54_q61(t, d):
    pairs = [(x["d_dimer"], d["patienthistory"][i]["cci_score"]) for i, x in d["labs"].items() if x["d_dimer"] is not None]
    full = [p for p in pairs if p[1] is not None]
    r = q.d_dimer_spread(t).first()
    assert r["variance"] == pytest.approx(st.pvariance([a for a, _ in pairs]))
    assert r["correlation"] == pytest.approx(st.correlation(*zip(*full)))
    wards = defaultdict(list)
    for h in d["hospitalization_discharge"].values():
        wards[h["admission_ward"]].append(h["outcome_during_hospitalization"] == "Dead")
    rate = {w: round(100 * sum(v) / len(v) + 1e-9, 2) for w, v in wards.items()}
    assert [r["admission_ward"] for r in q.lowest_death_rate_ward(t).collect()] == sorted(rate, key=lambda w: (rate[w], w))[:3]
    coma = [i for i, x in d["responsivenes"].items() if x["gcs"] <= 8]
    sick = sum(d["patienthistory"][i]["diabetes"] == 1 for i in coma)
    assert got(q.coma_with_diabetes(t)) == [(len(coma), sick, pytest.approx(100 * sick / len(coma), abs=0.0051))]
    for r in q.readmission_by_destination(t, 20).collect():
        flags = [h["re_admission_within_28_days"] for h in d["hospitalization_discharge"].values()
                 if h["destinationdischarge"] == r["destinationdischarge"]]
        assert (r["total_patients"], r["readmitted"]) == (len(flags), sum(flags))
        assert r["criteria"].startswith("high" if 100 * sum(flags) / len(flags) > 20 else "low")


def test_q55_q68_q74_q76(t, rows, d):
    youngest = min((p for p in rows["demography"] if p["age"] is not None), key=lambda p: (p["age"], p[ID]))[ID]
    same(q.drugs_of_youngest(t), [(p[ID], p["drug_name"]) for p in rows["patient_precriptions"] if p[ID] == youngest])
    sick = [h for i, h in d["patienthistory"].items() if d["cardiaccomplications"][i]["type_of_heart_failure"] == "Both"
            and 1 in (h["moderate_to_severe_chronic_kidney_disease"], h["leukemia"], h["malignant_lymphoma"])]
    want = ("Both", len(sick), sum(h["moderate_to_severe_chronic_kidney_disease"] or 0 for h in sick),
            sum((h["leukemia"] or 0) + (h["malignant_lymphoma"] or 0) for h in sick))
    same(q.both_failures_with_kidney_or_cancer(t), [want])
    groups = defaultdict(list)
    for i, h in d["patienthistory"].items():
        b = d["demography"][i]["bmi"]
        if h["cci_score"] is not None:
            groups["no bmi" if b is None or b == 30 else "less than 30" if b < 30 else "more than 30"].append(h["cci_score"])
    assert {r[0]: pytest.approx(r[1]) for r in q.cci_by_bmi(t).collect()} == {k: st.mean(v) for k, v in groups.items()}
    obese = Counter((p["agecat"], p["gender"]) for p in rows["demography"]
                    if p["bmi"] and p["bmi"] >= 30 and p["agecat"] and p["gender"])
    r = q.most_obese_group(t).first()
    assert ((r["agecat"], r["gender"]), r["patients"]) == min(obese.items(), key=lambda x: (-x[1], x[0]))


def test_q56_q57_q75_rules(spark, t, rows):
    accepted, rejected = q.checked_responses(t, F.col("movement") > 2)
    assert accepted.count() + rejected.count() == len(rows["responsivenes"])
    assert rejected.filter("movement > 2").count() == 0
    words = spark.createDataFrame([("mom",), ("girl",)], "word string")
    same(q.palindromes(words), [("mom", True), ("girl", False)])
    new = spark.createDataFrame([(15, 46.0), (16, None), (17, 40.0)], "inpatient_number long, bmi double")
    assert [r[ID] for r in q.bmi_alerts(new).collect()] == [15]


def test_q26_q27_q63_q64_q69_q70_q73_q78_text(t, rows, d):
    for r in q.personal_markers(t).collect():
        x, p = d["labs"][r[ID]], d["demography"][r[ID]]
        assert r["personal_markers"][0] == p["gender"] and r["personal_markers"][2] == f"{x['pulse']:.2f}"
        assert r["personal_markers"][1] == (None if p["bmi"] is None else f"{p['bmi']:.2f}")
    same(q.hydro_drugs(t), [("hydrochlorothiazide tablet", "H2O")])
    first = q.joined_demography(t).first()[0]
    assert first == max(f"{p['age'] or 0} ; {p['gender'] or 'NA'} ; {p[ID]}" for p in rows["demography"])
    assert all(r["reversed"] == r["drug_name"][::-1] for r in q.reversed_drugs(t).collect())
    same(q.occupation_lengths(t), {(o, len(o), 8 * len(o), 8 * len(o)) for o in
                                   (p["occupation"] for p in rows["demography"]) if o})
    assert str(q.with_date(t, "2024-05-01").first()["today_date"]) == "2024-05-01"
    assert "age" not in q.without_age(t).columns
    assert {r["type_ii_respiratory_failure"] for r in q.upper_respiratory_failure(t).collect()} == {"NONTYPEII", "TYPEII"}


def test_q79_q80_linked(t, rows):
    drugs = rows["patient_precriptions"]
    hits = [p for p in drugs if "digoxin" in p["drug_name"].lower() or "furosemide" in p["drug_name"].lower()]
    assert q.drugs_matching(t).count() == len(hits)
    users = {p[ID] for p in drugs if p["drug_name"] == "Furosemide injection"}
    same(q.linked_to_drug(t), [(p[ID], p["drug_name"]) for p in drugs if p[ID] in users])


def test_extras(t, rows, d):
    people = rows["demography"]
    want = [(f"{a} years", sum(p["gender"] == "Male" for p in people if p["agecat"] == a),
             sum(p["gender"] == "Female" for p in people if p["agecat"] == a)) for a in {p["agecat"] for p in people} if a]
    same(q.by_gender_and_age(t), want)
    for r in q.bmi_recomputed(t).collect():
        p = d["demography"][r[ID]]
        if p["bmi"] is None:
            assert r["same"] is None
        else:
            assert r["same"] == (abs(p["weight"] / p["height"] ** 2 - p["bmi"]) < 0.006)
    same(q.by_killip_grade(t), [(g, q.KILLIP.get(g, "unknown"), n) for g, n in
                                Counter(c["killip_grade"] for c in rows["cardiaccomplications"]).items()])
    assert {len(r[1]) for r in got(q.padded_ids(t))} == {12}
    assert {r["sno"] % 2 for r in q.alternate_rows(t).collect()} == {1}
    assert q.alternate_rows(t).count() + q.alternate_rows(t, even=True).count() == 60
    stays = q.stay_by_conditions(t).collect()
    assert stays and all(1 in (r["diabetes"], r["cerebrovascular_disease"], r["chronic_obstructive_pulmonary_disease"]) for r in stays)
