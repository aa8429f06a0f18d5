import numpy as np

from millrace.llm import toxicity_fm as X


def docs_and_labels(spark, make):
    random = np.random.default_rng(2)
    plain = [f"plain{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1500):
        words = list(random.choice(plain, 12))
        insult, group = random.random() < 0.3, random.random() < 0.3
        words += ["fool"] * insult + ["zorgs"] * group
        rows.append((i, " ".join(random.permutation(words)), "a"))
        labels.append((i, int(insult and group)))
    return make(rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_a_pair_counts_that_no_linear_sum_of_its_words_needs(spark, make):
    docs, labels = docs_and_labels(spark, make)
    machine = X.fit(docs, labels.where(X.remainder() != 0))
    scored = {r.doc_id: r.score for r in X.score_texts(docs, machine, ["doc_id"]).collect()}
    held = labels.where(X.remainder() == 0).collect()
    assert np.mean([(scored[r.doc_id] >= 0.5) == r.toxic for r in held]) > 0.97
    score = X.scorer(machine)
    both, one, other, none = score(["you fool zorgs", "you fool", "the zorgs", "you"])
    assert both > 0.5 > max(one, other, none)


def test_a_pair_counts_whose_words_say_nothing_alone(spark, make):
    random = np.random.default_rng(5)
    plain = [f"plain{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(4000):
        one, other = random.random() < 0.5, random.random() < 0.5
        words = list(random.choice(plain, 12)) + ["dark"] * one + ["moon"] * other
        rows.append((i, " ".join(random.permutation(words)), "a"))
        labels.append((i, int(one == other)))
    docs, labels = make(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    machine = X.fit(docs, labels.where(X.remainder() != 0))
    scored = {r.doc_id: r.score for r in X.score_texts(docs, machine, ["doc_id"]).collect()}
    held = labels.where(X.remainder() == 0).collect()
    assert np.mean([(scored[r.doc_id] >= 0.5) == r.toxic for r in held]) > 0.95


def test_the_layout_of_the_rows_does_not_matter(spark, make):
    docs, labels = docs_and_labels(spark, make)
    one = X.fit(docs.coalesce(1), labels)
    other = X.fit(docs.orderBy("text").repartition(5), labels.repartition(3))
    assert one.place == other.place and np.array_equal(one.weights, other.weights) and np.array_equal(one.factors, other.factors)


def test_logit_is_the_sum_over_pairs():
    random = np.random.default_rng(0)
    machine = X.Machine(0.3, {}, random.normal(size=6), random.normal(size=(6, 4)))
    rows = [[0, 2, 5], [1], []]
    want = [
        0.3 + sum(machine.weights[i] for i in r) + sum(machine.factors[i] @ machine.factors[j] for i in r for j in r if i < j)
        for r in rows
    ]
    assert np.allclose(machine.logit(rows), want)


def test_whole_texts_are_read(spark, make):
    docs, labels = docs_and_labels(spark, make)
    score = X.scorer(X.fit(docs, labels))
    late = "plain1 " * 100_000 + "fool zorgs"
    assert score([late])[0] > 0.5


def test_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(2, 0), (4, None), (5, 1), (5, 0), (None, 1)], "doc_id long, toxic int")
    machine = X.fit(awkward, labels)
    got = X.score_texts(awkward, machine, ["doc_id"]).collect()
    assert len(got) == awkward.count() and all(0 <= r.score <= 1 for r in got)
    assert awkward.where(X.score_column(machine) < 2).count() == awkward.count()


def test_without_labels_or_rows(spark, make, awkward):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert X.fit(awkward, none) is None
    assert {r.score for r in X.score_texts(awkward, None, ["doc_id"]).collect()} == {0.0}
    some = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert X.fit(make([]), some) is None
    assert X.score_texts(make([]), None, ["doc_id"]).collect() == []
