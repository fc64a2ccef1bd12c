"""Language identification learns from every labelled document, and its bounds come from all that are held out."""

import numpy as np
from pyspark.sql import functions as F

from affinity.llm.lang_id import DIMS, LEAST_HELD, MARGIN, Discriminator, held_out, train, train_pairs, trigram_counts

WORDS = {"de": "der hund und die katze sind nicht hier", "en": "the dog and the cat are not over here", "fr": "le chien et le chat ne sont pas ici"}


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)


def some(n):
    """Many English rows, a quarter as many German, few French; each row has a word of its own."""
    rows = []
    for k in range(n):
        lang = "fr" if k % 40 == 0 else "de" if k % 4 == 0 else "en"
        rows.append((k, f"{WORDS[lang]} {chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}q", lang))
    return rows


def sparse(text):
    c = trigram_counts(text.encode())
    return np.flatnonzero(c), c[np.flatnonzero(c)].astype(float)


def learned(spark, rows):
    ids = spark.createDataFrame([(r[0],) for r in rows], "doc_id long")
    held = {r[0] for r in ids.where(held_out(F.col("doc_id"))).collect()}
    return [r for r in rows if r[0] not in held], [r for r in rows if r[0] in held]


def test_every_labelled_row_counts(spark):
    rows = some(1600)
    used, held = learned(spark, rows)
    assert sum(r[2] == "en" for r in used) > 800
    model = train(docs(spark, rows), judge=True, shard_rows=100)
    # The families' probabilities are those of all rows, which the 400 of a language were not.
    plain = Discriminator([r[2] for r in used], [sparse(r[1]) for r in used])
    assert model.langs == plain.langs and np.array_equal(model.log_p, plain.log_p)
    fits = {f: [] for f in model.families}
    for _, text, lang in held:
        c = trigram_counts(text.encode()).astype(np.float32)[None]
        family, x = model.fit(c)
        if (lang == "fr") == (model.families[family[0]] == "romance"):
            fits[model.families[family[0]]].append(float(x[0]))
    for f, least in zip(model.families, model.least):
        x = sorted(fits[f])
        assert (least == -np.inf) == (len(x) < LEAST_HELD)
        if least > -np.inf:
            assert x[0] - 1e-6 <= least + MARGIN <= x[len(x) // 50 + 1] + 1e-6
    # All are rightly told apart by the machines of many shards.
    lang, score = model.predict(np.stack([trigram_counts(r[1].encode()).astype(np.float32) for r in rows]))
    assert lang == [r[2] for r in rows] and ((0 <= score) & (score <= 1)).all()
    # The same rows in other partitions give the same model.
    again = train(docs(spark, rows[::-1]).repartition(3), judge=True, shard_rows=100)
    assert all(np.array_equal(model.machines[p], again.machines[p]) for p in model.machines)
    assert np.array_equal(model.least, again.least)


def test_one_shard_is_plain_training(spark):
    used, _ = learned(spark, some(200))
    model = train(docs(spark, used), shard_rows=1000)
    rows = sorted((r[2], sparse(r[1])[0].astype("<u2").tobytes(), sparse(r[1])[1].astype("<u4").tobytes(), r[1]) for r in used)
    pairs = train_pairs([r[0] for r in rows], [sparse(r[3]) for r in rows])
    assert set(pairs) == {("de", "en")} and set(model.machines) == {(0, 1)}
    assert np.allclose(model.machines[0, 1], pairs["de", "en"][0], atol=1e-6) and len(model.machines[0, 1]) == DIMS + 1
