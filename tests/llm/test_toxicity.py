import random

from forgeline.llm import toxicity as T

CLEAN = [f"term{i}" for i in range(400)]
BAD = ["vilebad", "grosso", "idiote"]


def corpus(n=240):
    r = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        w = [r.choice(CLEAN) for _ in range(r.randint(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2 + len(w) // 20):
                w.insert(r.randrange(len(w)), r.choice(BAD) + r.choice(["", "x", "ly"]) if r.random() < 0.5 else r.choice(BAD))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_folding():
    assert T.folded("L0SER, id!ot  1,000 thіs") == " loser idiot 1 000 this "
    assert T.folded("") == "  " and T.folded("слово") == " слово "


def test_hits_respect_exceptions():
    m = T.Model({" bad ": 2.0, " gro": 1.0}, [" bad weather "])
    a = m.automaton()
    assert [h[2] for h in T.hits(a, T.folded("bad weather, a bad grosso"))] == [2.0, 1.0]
    assert T.features(a, "nothing here") == (0, 0.0, 0.0) and T.hits(T.Model().automaton(), " bad ") == []


def test_learns_and_separates_held_out(spark, frame):
    rows, labels = corpus()
    docs = frame(rows)
    model = T.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {"vilebad", "grosso", "idiote"} <= {t.strip() for t in model.terms} | {t.strip()[:7] for t in model.terms}
    got = {r.doc_id: r for r in T.score_documents(docs, model).collect()}
    truth = dict(labels)
    held = [d for d in got if got[d].held_out]
    assert held and sum(got[d].predicted == truth[d] for d in held) / len(held) >= 0.95
    import zlib

    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d in got)
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = T.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {d for d in got if not got[d].predicted}


def test_one_and_many_batches_give_one_model(spark, frame):
    rows, labels = corpus()
    # "plain vilebad" is far likelier in toxic rows, "fine grosso" is at home in clean ones
    more = [(f"plain vilebad u{i} " + "vilebad " * 5, 1) for i in range(40)] + [(f"plain vilebad c{i}", 0) for i in range(10)]
    more += [(f"fine grosso c{i}", 0) for i in range(10)]
    more += [(f"{CLEAN[i % 400]} k{i}", 0) for i in range(900)]
    docs = frame(rows + [(1000 + i, t) for i, (t, _) in enumerate(more)])
    known = spark.createDataFrame(labels + [(1000 + i, y) for i, (_, y) in enumerate(more)], "doc_id long, toxic int")
    models = []
    settings = ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for values in (("1", "10000", "true"), ("4", "1", "false")):
            for k, v in zip(settings, values, strict=True):
                spark.conf.set(k, v)
            models.append(T.fit(docs, known, held_out=3))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    one, many = models
    assert one.terms == many.terms and one.exceptions == many.exceptions and one.prior == many.prior
    assert all(abs(a - b) < 1e-6 for a, b in zip(one.coefficients, many.coefficients, strict=True))
    assert " fine grosso " in one.exceptions and " plain vilebad " not in one.exceptions


def test_edge_cases(spark, frame):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = frame([(1, None), (2, ""), (None, "x"), (2, ""), (3, "y " * 50000)])
    model = T.fit(docs, none)
    got = T.score_documents(docs, model).collect()
    assert len(got) == 5 and {r.score for r in got} == {0.0}
    only = T.fit(docs, spark.createDataFrame([(1, 1), (2, 1), (3, None)], "doc_id long, toxic int"))
    assert only.terms == {} and T.score_documents(docs, only).count() == 5
    assert T.score_documents(frame([]), model).count() == 0 and T.without_toxic(frame([]), model).count() == 0
