import numpy as np

from reelrank.llm import langid


def features(found):
    return set(langid.feature_rows(found)[0].tolist()) - {langid.DIM}


def test_every_ngram_of_a_long_run_is_read():
    rng = np.random.default_rng(3)
    for n in (39, 40, 41, 79, 80, 81, 137, 1000):
        run = "".join(rng.choice(list("abcdefghij"), n))
        found = langid.words(run)
        assert max(len(w.strip(langid.ON)) for w in found) <= langid.LONG + 3
        whole = features([run]) - {langid.zlib.crc32(run.encode()) & (langid.DIM - 1)}
        assert whole <= features(found)
        grams = [f for f in langid.feature_rows([run])[0].tolist() if f != langid.DIM]
        grams.remove(langid.zlib.crc32(run.encode()) & (langid.DIM - 1))
        parts = [f for f in langid.feature_rows(found)[0].tolist() if f != langid.DIM]
        for w in found:
            parts.remove(langid.zlib.crc32(w.encode()) & (langid.DIM - 1))
        assert sorted(grams) == sorted(parts) or n <= 40  # each n-gram once
        assert len(found) == -(-n // langid.LONG)


def test_languages_inside_one_run():
    rng = np.random.default_rng(4)

    def run(letters, n):
        return "".join(rng.choice(list(letters), n))

    chains = [(lang, [run(letters, 12) for _ in range(30)]) for lang, letters in (("aa", "abcdef"), ("zz", "uvwxyz")) for _ in range(60)]
    model = langid.train(chains, epochs=4)
    labeller = langid.Labeller(model)
    text = run("abcdef", 40) + run("uvwxyz", 400) + run("abcdef", 40)
    assert langid.label_texts(labeller, [text])[0] == ["zz"]
    post = labeller.label([langid.words(text)])[0].argmax(axis=1)
    assert post[0] == 0 and post[-1] == 0 and (post[2:-2] == 1).all()
