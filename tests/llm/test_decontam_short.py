import random

from reelrank.llm import decontam as D

from test_decontam import whole_distance, whole_words


def test_short_items_by_enumeration():
    random.seed(7)
    words = ["".join(random.choice("abc") for _ in range(random.randint(1, 6))) for _ in range(25)]
    items = {" ".join(random.choice(words) for _ in range(random.randint(1, 6)))[:24].strip() for _ in range(40)}
    items = list(enumerate(sorted(items)))
    matcher = D.Matcher([(i, p, 1) for i, p in items], 0.1)
    hits = 0
    for _ in range(120):
        s = " ".join(random.choice(words) for _ in range(6)) + " " + random.choice(items)[1] + " " + random.choice(words)
        if random.random() < 0.6:
            at = random.randrange(len(s))
            s = s[:at] + random.choice("abc ") + s[at + random.randint(0, 1):]
        t = D.normalise(s)
        want = {(i, d) for i, p in items if (d := whole_words(p, t, int(0.1 * len(p)))) is not None}
        got = matcher.find(t)
        assert {(i, d) for i, d, *_ in got} == want
        assert all(whole_distance(dict(items)[i], t[b:e]) == d for i, d, _, b, e, _ in got)
        hits += len(want)
    assert hits > 100


def test_short_item_inside_a_document(spark):
    docs = spark.createDataFrame([(1, "He asked: what is the capital of Peru? Lima."), (2, "whatever is said"), (3, "The capital is Lim.")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "What is the capital?"), (2, "Lima"), (3, "what"), (4, "capitol of peru")], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.distance) for r in D.op2_decontamination(docs, bench).collect()}
    assert got == {(1, 1, 0), (1, 2, 0), (1, 3, 0), (1, 4, 1)}
    assert [r.doc_id for r in D.decontaminate(docs, bench).orderBy("doc_id").collect()] == [2, 3]
