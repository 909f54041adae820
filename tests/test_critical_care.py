"""Critical-care questions against brute force over the fixture rows."""

import datetime as dt
import inspect
import statistics as st
from collections import Counter, defaultdict

import pytest

import clinic
from wardlens.plans import critical_care as q

P, S = "patient_id", "inp_no"


@pytest.fixture(scope="module")
def rows():
    return clinic.critical_rows()


@pytest.fixture(scope="module")
def t(spark, rows, tmp_path_factory):
    return clinic.tables(spark, clinic.CRITICAL, rows, str(tmp_path_factory.mktemp("critical")))


@pytest.fixture(scope="module")
def who(rows):
    """Patient row by stay number."""
    return {b[S]: b for b in rows["baseline"]}


@pytest.fixture(scope="module")
def person(rows):
    return {b[P]: b for b in rows["baseline"]}


@pytest.fixture(scope="module")
def chart(rows, who):
    """Chart rows with their patient's columns."""
    return [{**c, **who[c[S]]} for c in rows["nursingchart"]]


def got(df):
    return [tuple(r) for r in df.collect()]


def same(df, want):
    assert sorted(map(repr, got(df))) == sorted(map(repr, want))


def by(items, *keys):
    out = defaultdict(list)
    for x in items:
        out[tuple(x[k] for k in keys) if len(keys) > 1 else x[keys[0]]].append(x)
    return out


def r2(x, digits=2):
    return round(x + 1e-9, digits)


def test_all_built_questions_are_listed():
    main = set(range(1, 81)) - {1, 23, 25, 44, 47, 62, 73}
    assert set(q.QUESTIONS) == {str(n) for n in main} | {f"A{n}" for n in range(1, 24)}


def test_every_question_over_tables_alone_runs(t):
    for number, fn in q.QUESTIONS.items():
        needed = [p for p in inspect.signature(fn).parameters.values() if p.default is p.empty]
        if [p.name for p in needed] == ["t"]:
            assert fn(t).columns and fn(t).count() >= 0, number


def test_q2_transfers_after_admission(t, rows):
    want = set()
    for pid, moves in by(rows["transfer"], P).items():
        admitted = [m for m in moves if m["startreason"] == "Admission"]
        first = min(m["starttime"] for m in admitted)
        depts = {(m["transferdept"], min(x["starttime"] for x in admitted if x["transferdept"] == m["transferdept"])) for m in admitted}
        for m in moves:
            if m["startreason"] == "Transfer" and m["starttime"] > first:
                want |= {(pid, "Transfer", m["starttime"], m["transferdept"], dept, at) for dept, at in depts}
    same(q.transfers_after_admission(t), want)


def test_q3_q9_percentiles(t, chart):
    values = [c["invasive_sbp"] for c in chart if c["admitdept"] == "ICU" and c["invasive_sbp"] is not None]
    median = st.median(values)
    best = {}
    for c in chart:
        if c["invasive_sbp"] is not None and c["invasive_sbp"] > median:
            best[c[S]] = max(best.get(c[S], (0, c["charttime"])), (c["invasive_sbp"], c["charttime"]))
    out = q.pressure_above_icu_median(t).collect()
    assert sorted((r["systolic_bp"], r["charttime"]) for r in out) == sorted(best.values())
    assert {r["median_icu"] for r in out} <= {median}
    want = set()
    for stay, cs in by([c for c in chart if c["blood_sugar"] is not None], S).items():
        vs = sorted(c["blood_sugar"] for c in cs)
        place = 0.99 * (len(vs) - 1)
        low = int(place)
        limit = vs[low] + (place - low) * (vs[min(low + 1, len(vs) - 1)] - vs[low])
        want |= {(stay, c["charttime"]) for c in cs if c["blood_sugar"] >= limit}
    assert {(r[S], r["charttime"]) for r in q.top_blood_sugar(t).collect()} == want


def test_q4_q5_latest(t, rows):
    want = []
    for pid, given in by(rows["drugs"], P).items():
        last = max(g["drug_time"] for g in given)
        at_last = sorted((g["drugname"], g["formula"]) for g in given if g["drug_time"] == last)[:10]
        want += [(pid, name, last, formula) for name, formula in at_last]
    same(q.last_drugs(t), want)
    counts = Counter(r[P] for r in q.recent_transfers(t).collect())
    assert counts == {pid: min(5, len(m)) for pid, m in by(rows["transfer"], P).items()}


def test_q6_q77_q33_series(t, chart):
    series = by([c for c in chart if c["heart_rate"] is not None], S)
    want = []
    for stay, cs in series.items():
        beats = [c["heart_rate"] for c in sorted(cs, key=lambda c: c["charttime"])]
        want += [(stay, r2(st.mean(beats[: k + 1]))) for k in range(len(beats))]
    same(q.rolling_heart_rate(t).select(S, "rolling"), want)
    jumps = []
    for stay, cs in by(chart, S).items():
        cs = sorted(cs, key=lambda c: c["charttime"])
        for a, b in zip(cs, cs[1:]):
            x, y = a["heart_rate"], b["heart_rate"]
            if x and y is not None and (y - x) * 100 / x > 30:
                jumps.append((b[P], b["charttime"], r2((y - x) * 100 / x)))
    same(q.heart_rate_jumps(t).select(P, "charttime", "increase_pct"), jumps)
    changes = []
    for stay, cs in by([c for c in chart if c["invasive_diastolic_blood_pressure"] is not None], S).items():
        v = [c["invasive_diastolic_blood_pressure"] for c in sorted(cs, key=lambda c: c["charttime"])]
        changes += [(stay, None if k == 0 else v[k] - v[k - 1]) for k in range(len(v))]
    same(q.diastolic_changes(t).select(S, "difference"), changes)


def ordered(moves):
    return sorted(moves, key=lambda m: (m["starttime"], m["stoptime"] or dt.datetime.min, m["transferdept"], m[S]))


def test_q7_q51_q57_transitions(t, rows):
    surgery, icu, disease = [], [], set()
    for pid, moves in by(rows["transfer"], P).items():
        moves = ordered(moves)
        for a, b in zip(moves, moves[1:]):
            if a["stopreason"] == "Patient pre discharge" and b["transferdept"] == "Surgery":
                surgery.append((pid, b["starttime"]))
            if a["transferdept"] == "Surgery" and b["transferdept"] == "ICU":
                hours = None if b["stoptime"] is None else (b["stoptime"] - b["starttime"]).total_seconds() / 3600
                icu.append((pid, b["starttime"], hours))
            if a["stopreason"] == "Disease change" and b["startreason"] == "Transfer":
                disease.add((pid, b["transferdept"]))
    same(q.back_to_surgery(t).select(P, "starttime"), surgery)
    same(q.icu_after_surgery(t).select(P, "icu_starttime", "time_spent_hours"), icu)
    same(q.transfers_after_disease_change(t).select(P, "transferdept"), disease)


def test_q8_q13_q14_q27_ages(t, rows):
    groups = by(rows["baseline"], "admitdept", "sex")
    same(q.mean_age_by_dept_and_sex(t), [(d, s, -int(-st.mean(b["age"] for b in v) // 1)) for (d, s), v in groups.items()])
    want = []
    for dept, people in by(rows["baseline"], "admitdept").items():
        top = sorted({b["age"] for b in people}, reverse=True)[:3]
        want += [(b[P], dept, b["age"], b["sex"], top.index(b["age"]) + 1) for b in people if b["age"] in top]
    same(q.oldest_by_dept(t), want)
    gone = [b["icu_discharge_time"] for b in rows["baseline"] if b["icu_discharge_time"]]
    same(q.discharged_in(t, 2020), [(sum(g.year == 2020 for g in gone),)])
    ages = [b["age"] for b in rows["baseline"]]
    same(q.age_groups(t), [(sum(a < 30 for a in ages), sum(30 <= a <= 60 for a in ages), sum(a > 60 for a in ages))])


def test_q10_q12_q42_names(t, rows):
    names = {i["icd_desc"] for i in rows["icd"]}
    same(q.last_letters(t), [(n, n[-6:] if len(n) >= 6 else None) for n in names])
    same(q.letter_position(t), [(n, n.index("y") + 1) for n in names if "y" in n])
    same(q.diseases_ending(t), [(n,) for n in names if n.endswith("itis")])


def test_q11_q40_drugs(t, rows, person, chart):
    totals = Counter((person[g[P]]["admitdept"], g["drugname"]) for g in rows["drugs"])
    want = [(d, n, k) for (d, n), k in totals.items() if k == max(x for (e, _), x in totals.items() if e == d)]
    same(q.top_drug_by_dept(t), want)
    out = {c[P] for c in chart if c["extubation"]}
    never = Counter(g["drugname"] for g in rows["drugs"] if g[P] not in out)
    assert got(q.top_drug_of_never_intubated(t)) == [min(never.items(), key=lambda x: (-x[1], x[0]))]
    same(q.tube_removed(t), [(p,) for p in out])


def test_q15_q30_q46_durations(t, rows, person):
    days = Counter()
    for m in rows["transfer"]:
        if m["transferdept"] == "ICU" and m["startreason"] == "Transfer" and m["stoptime"]:
            days[m[P]] += (m["stoptime"] - m["starttime"]).days
    same(q.icu_days(t), [(p, n) for p, n in days.items() if n])

    def hours(m):
        return (m["stoptime"] - m["starttime"]).total_seconds() / 3600

    soft = [hours(m) for m in rows["transfer"] if m["stoptime"] and person[m[P]]["infectionsite"] == "Soft Tissue"]
    assert q.mean_stay_hours(t).first()[0] == pytest.approx(st.mean(soft))
    vital = {o[P]: o["follow_vital"] for o in rows["outcome"] if o["follow_vital"]}
    groups = defaultdict(list)
    for m in rows["transfer"]:
        if m[P] in vital:
            groups[(m["transferdept"], vital[m[P]])] += [hours(m)] if m["stoptime"] else []
    same(q.time_by_dept_and_outcome(t), [(d, v, r2(st.mean(h)) if h else None) for (d, v), h in groups.items()])


def test_q16_q20_q67_pressure(t, chart):
    known = by([c for c in chart if c["invasive_sbp"] is not None], "admitdept", P)
    want = [(d, p, min(v), max(v), int(st.mean(v) * 100 + 1e-9) / 100)
            for (d, p), v in ((k, [c["invasive_sbp"] for c in cs]) for k, cs in known.items())]
    same(q.pressure_by_patient(t), want)
    falls = []
    both = [c for c in chart if c["invasive_sbp"] is not None and c["invasive_diastolic_blood_pressure"] is not None]
    for stay, cs in by(both, S).items():
        mean = {}
        for day, xs in by([{**c, "day": c["charttime"].date()} for c in cs], "day").items():
            mean[day] = (st.mean(c["invasive_sbp"] for c in xs), st.mean(c["invasive_diastolic_blood_pressure"] for c in xs))
        for day in mean:
            b, a = day - dt.timedelta(days=1), day - dt.timedelta(days=2)
            if a in mean and b in mean and all(mean[day][k] < mean[b][k] < mean[a][k] for k in (0, 1)):
                falls.append((stay, day))
    same(q.pressure_falls(t).select(S, "day"), falls)
    runs = []
    for stay, cs in by([c for c in chart if c["invasive_sbp"] is not None], S).items():
        cs = sorted(cs, key=lambda c: c["charttime"])
        k = 0
        while k < len(cs):
            end = k
            while end < len(cs) and cs[end]["invasive_sbp"] == cs[k]["invasive_sbp"]:
                end += 1
            if end - k > 2:
                runs.append((stay, cs[k]["invasive_sbp"], end - k))
            k = end
    same(q.repeated_pressure(t).select(S, "invasive_sbp", "readings"), runs)
    assert q.repeated_pressure(t, by_day=True).count() >= 0


def test_q17_q31_tables(t, rows, tmp_path):
    want = Counter(b["admitdept"] for b in rows["baseline"]).items()
    same(q.patients_per_dept(t, str(tmp_path / "counts")), want)
    year = next(b["icu_discharge_time"].year - b["age"] for b in rows["baseline"] if b["icu_discharge_time"])
    born = [(b[P], b["age"], b["sex"], b["icu_discharge_time"].year) for b in rows["baseline"]
            if b["icu_discharge_time"] and b["icu_discharge_time"].year - b["age"] == year]
    same(q.born_in(t, year, str(tmp_path / "born")), born)


def test_q18_q35_q53_q63_transfer_counts(t, rows):
    moves = rows["transfer"]
    surgeries = Counter(m[P] for m in moves if m["startreason"] == "Transfer" and m["transferdept"] == "Surgery")
    assert got(q.most_surgeries(t)) == sorted(surgeries.items(), key=lambda x: (-x[1], x[0]))[:3]
    cells = Counter((m[P], m["transferdept"]) for m in moves)
    same(q.transfers_by_dept(t), [(p, *[cells.get((p, d)) for d in ("ICU", "Surgery", "Medical Specialties")])
                                  for p in {m[P] for m in moves}])
    icu = Counter(m[P] for m in moves if m["transferdept"] == "ICU")
    same(q.rank_by_icu_visits(t), [(p, n, 1 + sum(x > n for x in icu.values())) for p, n in icu.items()])
    daily = Counter((m[P], m[S], m["transferdept"], m["starttime"].date()) for m in moves)
    same(q.twice_into_dept_in_a_day(t), [(*k, n) for k, n in daily.items() if n == 2])


def test_q19_q21_q22_q24_q32_q74_readings(t, rows, chart):
    same(q.pain_score_is(t), {(c[P], "0") for c in chart if c["cpot_pain_score"] == "0"})
    health = {o[P]: o["sf36_generalhealth"] for o in rows["outcome"] if o["sf36_generalhealth"]}
    fast = by([c for c in chart if c["breathing"] > 20 and c[P] in health], P)
    same(q.health_of_fast_breathers(t), [(p, max(c["breathing"] for c in cs), health[p]) for p, cs in fast.items()])
    beats = [c["heart_rate"] for c in chart if c["heart_rate"] is not None]
    m, s = st.mean(beats), st.pstdev(beats)
    out = by([c for c in chart if c["heart_rate"] is not None and abs(c["heart_rate"] - m) > 2 * s], P)
    same(q.heart_rate_outliers(t), [(p, max(c["heart_rate"] for c in cs)) for p, cs in out.items()])
    hot = by([c for c in chart if c["temperature"] is not None and c["temperature"] > 38], P)
    same(q.fever(t), [(p, max(c["temperature"] for c in cs)) for p, cs in hot.items()])
    days = by([{**c, "day": c["charttime"].date()} for c in chart if c["admitdept"] == "Surgery"], "day")

    def peak(cs, column):
        return max((c[column] for c in cs if c[column] is not None), default=None)

    same(q.daily_peaks(t), [(d, peak(cs, "temperature"), peak(cs, "heart_rate")) for d, cs in days.items()])
    young = by([c for c in chart if c["age"] < 40 and c["heart_rate"] is not None], P)
    same(q.heart_rate_of_young(t), [(p, r2(st.mean(c["heart_rate"] for c in cs))) for p, cs in young.items()])


def test_q26_q45_q55_q56_statistics(t, rows, chart):
    pairs = [((c["icu_discharge_time"] - dt.datetime(1970, 1, 1)).total_seconds(), c["blood_sugar"]) for c in chart
             if c["icu_discharge_time"] and c["blood_sugar"] is not None]
    assert q.sugar_discharge_correlation(t).first()[0] == pytest.approx(st.correlation(*zip(*pairs)))
    sugars = {p: [c["blood_sugar"] for c in cs if c["blood_sugar"] is not None] for p, cs in by(chart, P).items()}
    unsteady = {p for p, v in sugars.items() if len(v) > 1 and st.stdev(v) > 2}
    same(q.health_of_unsteady_sugar(t), [(o[P], o["sf36_generalhealth"]) for o in rows["outcome"]
                                         if o["sf36_generalhealth"] and o[P] in unsteady])
    flows = {d: [float(c["oxygen_flow"]) for c in cs if c["oxygen_flow"] not in (None, "x")] for d, cs in by(chart, "admitdept").items()}
    same(q.oxygen_flow_spread(t), [(d, r2(st.variance(v)), r2(st.stdev(v))) for d, v in flows.items()])
    low = [v for v in sugars.values() if v and st.mean(v) < 120]
    same(q.highest_sugar_of_low_mean(t), [(max((x for v in low for x in v), default=None),)])


def test_q28_q29_q36_q61(t, rows):
    gone = Counter(b["icu_discharge_time"].hour for b in rows["baseline"] if b["icu_discharge_time"])
    assert q.least_busy_discharge_hour(t).first()["discharges"] == min(gone.values())
    picked = q.random_with_infection(t)
    assert picked.count() == 3 and {r["infectionsite"] for r in picked.collect()} == {"UTI"}
    drawn = [r[0] for r in q.normal_ages(t, n=500).collect()]
    third = sorted({b["age"] for b in rows["baseline"]})[2]
    assert len(drawn) == 500 and abs(st.mean(drawn) - third) < 0.6 and 2.4 < st.stdev(drawn) < 3.6
    times = sorted((b["icu_discharge_time"] for b in rows["baseline"] if b["icu_discharge_time"]), reverse=True)
    assert [r["icu_discharge_time"] for r in q.last_discharged(t, 7).collect()] == times[:7]


def test_q34_q37_q38_q59_q60_filters(t, rows):
    assert q.fed_without_urine(t).count() == sum(
        c["milk"] is not None and c["soft_food"] is not None and c["urine_volume"] == 0 for c in rows["nursingchart"])
    outs = rows["outcome"]
    assert q.vigorous_without_pain(t).count() == sum(
        o["sf36_activitylimit_vigorousactivity"] is not None and o["sf36_pain_bodypainpast4wk"] == "1_None" for o in outs)
    same(q.poor_health_view(t), [(o[P], "5_Poor") for o in outs if o["sf36_generalhealth"] == "5_Poor"])
    assert q.always_happy(t).count() == sum(o["sf36_emotional_happyperson"] == "1_All of the time" for o in outs)
    same(q.discharged_in_month(t), [(b[P], b[S]) for b in rows["baseline"]
                                    if b["icu_discharge_time"] and b["icu_discharge_time"].month == 12])


def test_q39_q70(spark, t):
    codes = spark.createDataFrame([("G93.812",), ("G900.812",)], "icd_code string")
    same(q.disease_exists(t, codes), [("G93.812", True), ("G900.812", False)])
    new = t.baseline.limit(30)
    accepted, rejected = q.checked_baseline(t, new)
    assert accepted.count() + rejected.count() == 30
    assert {r["admitdept"] for r in accepted.collect()} == {"ICU"}


def test_q43_report(t, rows, chart):
    groups, given = by(chart, P), Counter(g[P] for g in rows["drugs"])

    def mean(p, column):
        v = [c[column] for c in groups.get(p, []) if c[column] is not None]
        return r2(st.mean(v)) if v else None

    same(q.patient_report(t), [(b[P], mean(b[P], "blood_sugar"), mean(b[P], "temperature"), mean(b[P], "heart_rate"), given[b[P]])
                               for b in rows["baseline"]])


def test_q48_q49_q72_q75_rates(t, rows, person, chart):
    mean = r2(st.mean(c["blood_oxygen_saturation"] for c in chart if c["blood_oxygen_saturation"] is not None))
    peaks = by([c for c in chart if c["admitdept"] == "ICU"], P)
    for r in q.oxygen_against_mean(t).collect():
        best = max((c["blood_oxygen_saturation"] for c in peaks[r[P]] if c["blood_oxygen_saturation"] is not None), default=None)
        assert (r["max_oxygen"], r["avg_oxygen"]) == (best, mean)
        assert r["oxygen_status"].split()[0] == ("Equal" if best in (None, mean) else "Above" if best > mean else "Below")
    for r in q.poor_health_by_dept(t).collect():
        seen = [o for o in rows["outcome"] if o["discharge_dept"] == r["discharge_dept"] and person[o[P]]["icu_discharge_time"]]
        poor = [o for o in seen if o["follow_vital"] == "Alive" and o["sf36_generalhealth"] == "5_Poor"
                and o["follow_date"] and o["follow_date"] > person[o[P]]["icu_discharge_time"]]
        assert (r["n"], r["hits"], r["poor_health_pct"]) == (len(seen), len(poor), r2(100 * len(poor) / len(seen)))
    vital = {o[P]: o["follow_vital"] for o in rows["outcome"] if o["follow_vital"]}
    low = [vital[c[P]] for c in chart if (c["blood_oxygen_saturation"] or 100) < 90 and c[P] in vital]
    same(q.alive_with_low_oxygen(t), [(f"{r2(100 * low.count('Alive') / len(low))}%",)])
    sick = {i[P] for i in rows["icd"] if i["icd_desc"] == "hypoproteinemia"}
    tubed = {c[P] for c in chart if c["endotracheal_intubation_depth"] is not None}
    same(q.intubated_share(t), [(r2(100 * len(sick & tubed) / len(sick)),)])


def test_q50_q64_q65(t, rows, who, chart):
    day = rows["nursingchart"][0]["charttime"].date()
    temps = [c["temperature"] for c in chart if c["charttime"].date() == day and c["temperature"] is not None]
    same(q.mean_temperature_on(t, [str(day), "2025-02-23"]),
         [(day, r2(st.mean(temps)) if temps else None), (dt.date(2025, 2, 23), None)])
    pairs = {(c[P], c["temperature"]) for c in chart if c["age"] > 60 and c["admitdept"] == "ICU" and c["temperature"] is not None}
    same(q.median_temperature(t), [(r2(st.median(v for _, v in pairs)),)])
    values = defaultdict(list)
    for x in rows["lab"]:
        if x["item"] == "Sodium (NA)" and x["labvalue"] is not None:
            values[who[x[S]][P]] += [float(x["labvalue"])] if x["labvalue"] in ("12", "140", "151.5") else []
    same(q.mean_sodium(t), [(p, r2(st.mean(v)) if v else None) for p, v in values.items()])


def test_q52_q58_q66_q68_q69_q76_q78_q79_q80(t, rows, person, chart):
    window = [g for g in rows["drugs"] if dt.time(4) <= g["drug_time"].time() <= dt.time(5)]
    same(q.drugs_between(t), {(g["drugname"], g["drug_time"].strftime("%H:%M:%S")) for g in window})
    counts = Counter(g[P] for g in rows["drugs"])
    same(q.drugs_of_elderly(t), [(p, n) for p, n in counts.items() if person[p]["age"] >= 65])
    worse = Counter(o["discharge_dept"] for o in rows["outcome"] if (o["sf36_oneyearcomparehealthcondition"] or "")[:1] == "5")
    same(q.much_worse_by_dept(t), worse.items())
    ages = sorted({person[o[P]]["age"] for o in rows["outcome"]})
    same(q.nth_youngest(t).select(P, "age"), [(o[P], person[o[P]]["age"]) for o in rows["outcome"] if person[o[P]]["age"] == ages[8]])
    modes = Counter(c["breathing_pattern"] for c in chart if c["infectionsite"] == "Pneumonia" and c["breathing_pattern"])
    same(q.ventilator_bars(t, per_mark=5), [(m.ljust(40), n, "▰" * (n // 5)) for m, n in modes.items()])
    entries = Counter(c[S] for c in rows["nursingchart"])
    assert {(r[S], r["entries"]) for r in q.long_charts(t, 10).collect()} == {(s, n) for s, n in entries.items() if n > 10}
    months = Counter((b["icu_discharge_time"].strftime("%Y"), b["icu_discharge_time"].strftime("%m"), b["icu_discharge_time"].strftime("%B"))
                     for b in rows["baseline"] if b["admitdept"] == "ICU" and b["icu_discharge_time"])
    assert got(q.discharges_by_month(t)) == sorted((*k, n) for k, n in months.items())
    pain = [o["sf36_pain_bodypainpast4wk"] for o in rows["outcome"] if o["sf36_pain_bodypainpast4wk"]]
    same(q.moderate_pain_share(t), [(r2(100 * pain.count("4_Moderate") / len(pain)),)])


def test_q71_surgery_within_days(t, rows):
    want = []
    unique = {tuple(m.items()): m for m in rows["transfer"]}.values()
    for d in unique:
        if d["stopreason"] == "Patient pre discharge":
            back = [s["starttime"] for s in unique if s[P] == d[P] and s["transferdept"] == "Surgery"
                    and s["stopreason"] == "be hospitalized" and dt.timedelta(0) <= s["starttime"] - d["starttime"] <= dt.timedelta(days=30)]
            want.append((d[P], d["starttime"], min(back, default=None), len(back)))
    same(q.surgery_within_days(t).select(P, "discharge_time", "admission_time", "followers"), want)
    assert any(w[3] for w in want)


def test_q71_keeps_rows_alike_but_for_one_column(spark, t):
    """Rows that differ in ``stopreason`` alone, and in where their NULLs stand, are different rows."""
    columns = t.transfer.columns
    at = dt.datetime(2024, 5, 1, 8)
    base = {c: None for c in columns} | {P: 77, "transferdept": "Surgery", "starttime": at}
    rows = [{**base, "stopreason": r} for r in ("Patient pre discharge", "be hospitalized", None)]
    table = spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], t.transfer.schema)

    class Only:
        transfer = table

    got = [tuple(r) for r in q.surgery_within_days(Only).select(P, "discharge_time", "admission_time", "followers").collect()]
    assert got == [(77, at, at, 1)]


def test_additional_departments(t, rows, person):
    for r in q.sexes_by_dept(t).collect():
        v = [b["sex"] for b in rows["baseline"] if b["admitdept"] == r["admitdept"]]
        assert r["male_pct"] == r2(100 * v.count("Male") / len(v))
    shares = {r["admitdept"]: r["pct"] for r in q.dept_share(t).collect()}
    assert shares == {d: r2(100 * n / 40) for d, n in Counter(b["admitdept"] for b in rows["baseline"]).items()}
    same(q.admitted_to(t), [(b[P], "ICU") for b in rows["baseline"] if b["admitdept"] == "ICU"])
    arrays = by(rows["baseline"], "admitdept")
    same(q.patients_of_dept(t), [(d, 0, sorted(b[P] for b in v)) for d, v in arrays.items()])
    vital = {o[P]: o["follow_vital"] for o in rows["outcome"]}
    alive = {d: [vital.get(b[P]) == "Alive" for b in v] for d, v in arrays.items()}
    same(q.survival_by_dept(t), [(d, len(v), sum(v), r2(100 * sum(v) / len(v))) for d, v in alive.items()])
    names = {k: short for k, (_, short) in q.YEAR_LABELS.items()}
    cells = Counter((o["discharge_dept"], o["sf36_oneyearcomparehealthcondition"]) for o in rows["outcome"])
    same(q.condition_by_dept(t), [(d, *[cells.get((d, k)) for k in names]) for d in arrays])


def test_additional_drugs_and_ages(t, rows, person):
    different = {p: {g["drugname"] for g in v} for p, v in by(rows["drugs"], P).items()}
    same(q.many_different_drugs(t, 6), [(p, len(v)) for p, v in different.items() if len(v) > 6])
    ages = Counter(b["age"] for b in rows["baseline"])
    same(q.most_common_age(t), [(min(ages, key=lambda a: (-ages[a], a)),)])
    sizes = Counter(r["quartile"] for r in q.age_quartiles(t).collect())
    assert sizes == {1: 10, 2: 10, 3: 10, 4: 10}

    def group(age):
        return "0-20" if age <= 20 else "21-40" if age <= 40 else "41-60" if age <= 60 else "61+"

    same(q.drugs_by_age_group(t), Counter(group(person[g[P]]["age"]) for g in rows["drugs"]).items())


def test_additional_labs_and_stays(t, rows, person, who, chart):
    def outside(x):
        limits = {"137--147": (137, 147), "3.5～5.5": (3.5, 5.5)}.get(x["reference"])
        return limits and x["labvalue"] in ("12", "140", "151.5") and not limits[0] <= float(x["labvalue"]) <= limits[1]

    bad = [x for x in rows["lab"] if outside(x)]
    assert bad
    same(q.labs_out_of_range(t), [tuple(x.values()) for x in bad])
    admitted = [m for m in rows["transfer"] if m["startreason"] == "Admission" and m["transferdept"] == "ICU" and m[S] in who]
    hours = {m[P]: (person[m[P]]["icu_discharge_time"] - m["starttime"]).total_seconds() / 3600
             for m in admitted if person[m[P]]["icu_discharge_time"]}
    excellent = {o[P] for o in rows["outcome"] if o["sf36_generalhealth"] == "1_Excellent"}
    mean = st.mean(hours.values())
    assert {r[P] for r in q.excellent_but_long_in_icu(t).collect()} == {p for p, h in hours.items() if h > mean and p in excellent}
    moved = {m[P] for m in rows["transfer"] if m["startreason"] == "Transfer"}
    same(q.discharged_without_transfer(t).select(P, "discharge_time"),
         [(m[P], m["starttime"]) for m in rows["transfer"] if m["startreason"] == "Patient pre discharge" and m[P] not in moved])
    codes = Counter(i[P] for i in rows["icd"])
    assert {r[P] for r in q.many_diseases_and_stay(t).collect()} == {p for p, n in codes.items() if n > 3 and person[p]["admitdept"] == "ICU"}
    kinds = Counter((i["status_discharge"], i["icd_desc"]) for i in rows["icd"])
    same(q.common_disease_by_status(t), [(s, d, n) for (s, d), n in kinds.items()
                                         if n == max(x for (e, _), x in kinds.items() if e == s)])


def test_additional_outcomes_and_sets(t, rows, who, chart):
    outs = rows["outcome"]
    lim = [len({o[P] for o in outs if o[f"sf36_activitylimit_{k}activity"] == "1_limited a lot"}) for k in ("vigorous", "moderate")]
    same(q.limited_patients(t), [tuple(lim)])
    pairs = [(q.YEAR_LABELS[o["sf36_oneyearcomparehealthcondition"]][0], q.DEPT_CODES.get(o["discharge_dept"], 0))
             for o in outs if o["sf36_oneyearcomparehealthcondition"]]
    assert q.condition_dept_correlation(t).first()[0] == pytest.approx(st.correlation(*zip(*pairs)))
    fluids = defaultdict(float)
    for c in rows["nursingchart"]:
        for column in ("milk", "fruit_juice", "soup"):
            if c[column] is not None:
                fluids[c[S]] += c[column]
    same(q.rank_by_fluids(t), [(s, v, 1 + sum(x > v for x in fluids.values())) for s, v in fluids.items()])
    groups = by(rows["transfer"], P, "starttime", "stoptime", "transferdept")
    twice = [m for k, v in groups.items() if None not in k and len({m[S] for m in v}) > 1 for m in v]
    same(q.duplicate_transfers(t).select(P, S, "starttime"), [(m[P], m[S], m["starttime"]) for m in twice])
    pupils = {(c[P], c["charttime"]) for c in chart if c["left_pupil_size"] not in (None, "-") and c["right_pupil_size"]
              and abs(float(c["left_pupil_size"]) - float(c["right_pupil_size"])) > 1}
    assert {(r[P], r["charttime"]) for r in q.unequal_pupils(t).collect()} == pupils
    icu = {m[P] for m in rows["transfer"] if m["transferdept"] == "ICU"}
    same(q.icu_and_drug(t), [(p,) for p in icu & {g[P] for g in rows["drugs"] if g["drugname"].startswith("Xing")}])
    labs = {x[S] for x in rows["lab"]}
    same(q.charted_without_labs(t), [(who[s][P],) for s in {c[S] for c in chart} - labs])
    season = {12: "Winter", 1: "Winter", 2: "Winter", 3: "Spring", 4: "Spring", 5: "Spring", 6: "Summer", 7: "Summer", 8: "Summer"}

    def seasons(times):
        return Counter(season.get(x.month, "Fall") for x in times if x)

    a = seasons(m["starttime"] for m in rows["transfer"] if m["startreason"] == "Admission")
    b = seasons(x["icu_discharge_time"] for x in rows["baseline"])
    c = seasons(o["follow_date"] for o in outs)
    same(q.events_by_season(t), [(s, a[s], b[s], c[s]) for s in set(a) | set(b) | set(c)])


def test_score_rank(t, chart):
    def agg(cs, column, fn):
        v = [c[column] for c in cs if c[column] is not None]
        return fn(v) if v else None

    scores = {}
    for p, cs in by(chart, P).items():
        parts = [agg(cs, "blood_sugar", st.mean), agg(cs, "heart_rate", max), agg(cs, "blood_oxygen_saturation", min)]
        if None not in parts:
            scores[p] = r2(sum(parts))
    same(q.score_rank(t), [(p, s, 1 + sum(x > s for x in scores.values())) for p, s in scores.items()])
