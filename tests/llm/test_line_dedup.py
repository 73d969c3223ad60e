import random

from forgeline.llm import line_dedup as D


def made(seed=2):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(800)}"
    pool = [" ".join(word() for _ in range(r.choice([1, 3, 9, 25]))) for _ in range(60)]
    runs = [[r.choice(pool) for _ in range(r.randint(2, 5))] for _ in range(6)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(r.randint(0, 8)):
            k = r.random()
            lines += [" ".join(word() for _ in range(r.randint(1, 30)))] if k < 0.6 else r.choice(runs) if k < 0.8 else [r.choice(pool)]
            if r.random() < 0.2:
                lines.append(r.choice(["", "  ", "\t"]))
        rows.append((i, "\n".join(x.upper() if r.random() < 0.2 else x.replace(" ", "  ", 1) if r.random() < 0.2 else x for x in lines)))
    return rows + [(100, None), (101, ""), (102, "same\nsame\nsame\nsame"), (103, "\n\n"), (104, " ".join(["long"] * 30))]


def test_matches_brute_force(frame):
    rows = made()
    docs = frame(rows)
    out = D.without_repeated_lines(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    want = D.brute_force(rows)
    assert got == want and sum(want[d] != t for d, t in rows) > 10


def test_edge_cases(frame):
    text = "first line here\nsecond line here\nthird"
    got = D.without_repeated_lines(frame([(2, text), (2, text), (1, text + "\nmore"), (None, text), (3, "x " * 60000 + "\n" + text), (4, None)])).collect()
    texts = {}
    for r in got:
        texts.setdefault(r.doc_id, []).append(r.text)
    assert texts[1] == [text + "\nmore"] and texts[2] == ["", ""] and texts[None] == [""] and texts[4] == [None]
    assert texts[3] == ["x " * 60000]
    assert D.without_repeated_lines(frame([])).count() == 0
