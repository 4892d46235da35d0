from pyspark.sql import functions as F

from reportlens.functions import lexicons as lx
from reportlens.operators import features
from reportlens.plans import cleaning

FIRST = "uid int, findings string, impression string, indication string, mesh_major string"


def first(spark):
    return spark.createDataFrame([
        (1, "The heart is normal in size.", "No acute disease.", None, "normal"),
        (2, "", None, "pain", ""),
        (3, "The heart is normal in size.", "No acute disease.", "x", "normal"),
        (4, "Short", "", "", "Opacity"),
        (5, "Large pleural effusion, 3.5 x 4 cm.", "Suggest CT scan.", "XXXX", "Pleural Effusion|Opacity"),
    ], FIRST)


def test_first_source_profile_and_log(spark):
    d = cleaning.clean_reports(first(spark), "en_v1")
    assert sorted(r["uid"] for r in d.collect()) == [1, 5]
    log = cleaning.cleaning_log(first(spark), cleaning.profile_steps("en_v1")).orderBy("step_no").collect()
    assert [(r["records"], r["removed"]) for r in log] == [(5, 0), (4, 1), (3, 1), (2, 1)]
    r = cleaning.retention(cleaning.cleaning_log(first(spark), cleaning.profile_steps("en_v1"))).first()
    assert (r["initial"], r["final"], r["retained_pct"]) == (5, 2, 40.0)


def test_log_of_a_step_that_compares_rows(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    raw = spark.createDataFrame([
        (1, text, "", None, ""), (1, "another text of the same report", "", None, ""), (2, "", "", None, ""),
        (3, f"{text} {text}", "", None, ""),  # as the first
        (4, "ab cd", "", None, ""), (5, "entirely different words in here", "", None, ""), (5, text, "", None, "")], FIRST)
    raw = raw.withColumn("seq", F.monotonically_increasing_id())
    steps = cleaning.profile_steps("en_v2", "seq", stop_words=["zz"])
    log = cleaning.cleaning_log(raw, steps, "seq").orderBy("step_no").collect()
    assert [(r["step"], r["records"], r["removed"]) for r in log] == [
        ("Raw input", 7, 0), ("Drop both-empty", 6, 1), ("Remove duplicates", 3, 3), ("Filter malformed", 2, 1)]
    assert log[2]["reason"] == "uid exact + TF-IDF cosine > 0.95"
    kept = cleaning.clean_reports(raw, "en_v2", order="seq", stop_words=["zz"])
    assert sorted(r["uid"] for r in kept.collect()) == [1, 5]
    plain = cleaning.cleaning_log(raw, cleaning.profile_steps("en_v2", near_duplicates=False), "seq").orderBy("step_no").collect()
    assert [r["removed"] for r in plain] == [0, 1, 2, 1]


def test_second_source_profiles(spark):
    raw = spark.createDataFrame([
        (0, 10, "057Y", "male", "Aspect normal du poumon droit/gauche", "RAS stable ici", "None"),
        (1, 10, "058Y", "F", "autre texte assez long pour rester ici", "", None),
        (2, None, "1", "F", "texte sans clé mais assez long", "x", None),
        (3, 11, "200Y", " F ", "Aspect normal du poumon droit/gauche", "RAS", " none "),
        (4, 12, "", "74", "  ", " ", "x"),
        (5, 13, None, None, "a b", "", ""),
    ], "seq int, ExamID int, PatientAge string, PatientGender string, Findings string, Impression string, Comparison string")
    raw = raw.withColumns({"Indication": F.lit("I"), "condition": F.lit("Mass")})
    v1 = {r["uid"]: r for r in cleaning.clean_reports(raw, "fr_v1", order="seq").collect()}
    assert set(v1) == {10, 11}
    assert v1[10]["findings_clean"] == "aspect normal du poumon droit. gauche" and v1[10]["patient_age"] == 57.0 and v1[10]["patient_gender"] == "M"
    assert v1[11]["patient_age"] == 200.0 and v1[11]["patient_gender"] is None
    v2 = {r["uid"]: r for r in cleaning.clean_reports(raw, "fr_v2", order="seq").collect()}
    assert set(v2) == {10, None}  # the copied findings text goes, the null key is one key
    assert v2[10]["comparison"] == "" and v2[10]["patient_gender"] is None and v2[10]["pathology_label"] == "Mass"
    for p, n in (("fr_v1", 2), ("fr_v2", 2)):
        log = cleaning.cleaning_log(raw, cleaning.profile_steps(p), "seq").orderBy("step_no").collect()
        assert log[0]["records"] == 6 and log[-1]["records"] == n
        assert all(a["records"] - b["records"] == b["removed"] for a, b in zip(log, log[1:]))


def test_features_by_hand(spark):
    d = cleaning.clean_reports(first(spark), "en_v1")
    f = {r["uid"]: r.asDict() for r in features.engineer_features(d, lx.EN).collect()}
    a, b = f[1], f[5]
    assert a["F01_clinical_sentiment"] == 0.0 and b["F01_clinical_sentiment"] == 1.0
    assert a["F02_clinical_entity_count"] == 1 and b["F03_severity_score"] == 3
    assert a["F06_word_count"] == 9 and a["F07_sentence_count"] == 2 and a["F05_impression_length"] == 3
    assert a["F08_findings_impression_ratio"] == 2.0 and b["F09_has_measurements"] == 1
    assert a["F10_negation_count"] == 1 and b["F11_primary_pathology"] == "Opacity/Mass" and b["F12_multi_label_count"] == 2
    assert b["F14_abbrev_density"] == 1 / 10 and b["F15_numerical_count"] == 2 and b["F19_has_recommendation"] == 1
    assert (a["F25_is_abnormal"], b["F25_is_abnormal"]) == (0, 1)
    # Vowel groups of: the heart is normal in size. no acute disease.
    syl = sum([1, 1, 1, 2, 1, 2, 1, 3, 3])
    assert abs(a["F13_flesch_kincaid"] - (0.39 * 9 / 2 + 11.8 * syl / 9 - 15.59)) < 1e-9


def test_features_stage_gives_the_same(spark, tmp_path):
    d = cleaning.clean_reports(first(spark), "en_v1")
    a = features.engineer_features(d).orderBy("uid").collect()
    b = features.engineer_features(d, stage=str(tmp_path / "rows")).orderBy("uid").collect()
    assert a == b


def test_row_features_run_on_a_stream(spark, tmp_path):
    d = first(spark).withColumns({"findings_clean": F.coalesce("findings", F.lit("")), "impression_clean": F.coalesce("impression", F.lit(""))})
    d.write.parquet(str(tmp_path / "in"))
    stream = features.row_features(spark.readStream.schema(d.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("row_features").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("row_features").count() == 5


def test_features_asked_for_are_the_same_and_write_no_texts(spark, monkeypatch):
    texts = [(i, "normal", f"No acute disease. Large nodule {i} mm, may be edema" + " severe" * (i % 3), "Stable. Effusion" * (i % 2),
              float(30 + i) if i % 4 else None, "M", "en") for i in range(9)]
    d = spark.createDataFrame(texts, "uid int, mesh_major string, findings_clean string, impression_clean string, patient_age double, "
                                     "patient_gender string, condition string")
    for lexicon in (lx.EN, lx.FR):
        full = features.engineer_features(d, lexicon)
        names = [c for c in full.columns if c[0] == "F"]
        want = {r["uid"]: r.asDict() for r in full.collect()}
        written = []

        def cut(df):
            written.append(df.columns)
            return df
        monkeypatch.setattr(features, "cut_lineage", cut)
        for name in names:
            got = features.engineer_features(d, lexicon, columns=["uid", name])
            assert got.columns == ["uid", name]
            assert {r["uid"]: r[name] for r in got.collect()} == {u: r[name] for u, r in want.items()}
        assert len(written) == 3 + (lexicon is lx.FR) and not {"text", "findings_clean"} & {c for cols in written for c in cols}
        monkeypatch.undo()
