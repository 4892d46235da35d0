import random

from pyspark.sql import functions as F

from reportlens.operators import summaries


def lcs(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b):
            cur.append(prev[j] + 1 if x == y else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def test_rouge_l_against_dynamic_programming(spark):
    rnd = random.Random(1)
    pairs = [(i, " ".join(rnd.choices("abcdef", k=rnd.randint(0, 80))), " ".join(rnd.choices("abcdef", k=rnd.randint(0, 80)))) for i in range(60)]
    d = spark.createDataFrame(pairs, "id int, r string, p string")
    got = {x["id"]: x for x in summaries.rouge_all(d, "id", "r", "p").collect()}
    for i, r, p in pairs:
        n, m = len(r.split()), len(p.split())
        want = lcs(r.split(), p.split()) / m if m else 0.0
        assert abs(got[i]["rougeL_p"] - want) < 1e-12
        assert got[i]["rougeL_f"] <= got[i]["rouge1_f"] + 1e-12
        assert (n and m) or got[i]["rouge1_f"] == 0.0


def test_rouge_counts_are_clipped(spark):
    d = spark.createDataFrame([(1, "the cat the dog", "the the the cat")], "id int, r string, p string")
    one = summaries.rouge_n(d, "id", "r", "p", 1).first()
    two = summaries.rouge_n(d, "id", "r", "p", 2).first()
    assert one["rouge1_p"] == 0.75 and one["rouge1_r"] == 0.75
    assert abs(two["rouge2_f"] - 1 / 3) < 1e-12


def test_extractive_summary(spark):
    d = spark.createDataFrame([(1, "Lungs clear. Heart normal. Lungs clear heart normal. Zebra"), (2, "Only one"), (3, ""), (4, None)], "id int, t string")
    got = {r["id"]: r["summary"] for r in summaries.extractive_summary(d, "id", "t", 2).collect()}
    assert "Lungs clear heart normal" in got[1] and "Zebra" not in got[1] and got[1].endswith(".")
    assert got[2] == "Only one." and got[3] == "" and got[4] == ""


def test_extractive_summary_with_given_vectors(spark):
    d = spark.createDataFrame([(1, "a. bb. ccc")], "id int, t string")
    def embed(s):  # the last two sentences point the same way
        return s.withColumn("vec", F.when(F.col("pos") == 0, F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0))))
    assert summaries.extractive_summary(d, "id", "t", 2, embed=embed).first()["summary"] == "bb. ccc."


def test_lead_n(spark):
    d = spark.createDataFrame([("A b. C 3.5 cm! D? E",)], "t string")
    assert d.select(summaries.lead_n("t", 2)).first()[0] == "A b. C 3.5 cm!"


def test_user_callback(spark):
    d = spark.createDataFrame([(1, "one two three", "one two")], "id int, s string, r string")
    got = summaries.evaluate_summaries(d, "id", "s", "r", {"head": summaries.as_summariser(lambda t: " ".join(t.split()[:2]))}).first()
    assert got["model"] == "head" and got["rouge1_f"] == 1.0 and got["rougeL_f"] == 1.0


def test_rare_terms_of_a_summary_are_met_by_term(spark, monkeypatch):
    """Terms beyond the broadcast ones weigh the same; repeated keys count together."""
    from reportlens.operators import corpus
    rnd = random.Random(4)
    rows = [(i % 25, ". ".join(" ".join(f"t{rnd.randrange(60)}" for _ in range(rnd.randrange(1, 9))) for _ in range(rnd.randrange(1, 7)))) for i in range(30)]
    d = spark.createDataFrame(rows + [(77, ""), (78, None)], "k int, t string")
    want = sorted(tuple(r) for r in summaries.extractive_summary(d, "k", "t").collect())
    monkeypatch.setattr(corpus, "BROADCAST_TERMS", 5)
    assert sorted(tuple(r) for r in summaries.extractive_summary(d, "k", "t").collect()) == want and len(want) == 32
