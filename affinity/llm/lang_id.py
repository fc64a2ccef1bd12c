"""Language identification by hierarchical discrimination.

1. A multinomial naive Bayes model over hashed byte trigrams gives the probability of each
   language family.
2. Inside the likeliest family, one-versus-one linear support vector machines part the
   languages; the language with most votes (ties: the larger sum of margins) is predicted.

Every labelled document that is not held out is learned from. Rows are dealt to shards by the hashes of their ids and
texts, some ``SHARD_ROWS`` of each language (a language with fewer rows than the largest of its family is in
several); a task sums the trigrams of each language and trains a shard's machines, and the machine of two languages
is the mean of its shards' (one-shot averaging), so no task holds more than a shard and the driver is sent a vector
for each language and machine. With ``per_language`` the models come from at most so many documents of each language,
those with the smallest hashes of their ids, on the driver. They are found below a bound of the hash that the languages'
counts give, so no task ranks a language's whole table. A document's features come from its whole text. The language,
source and id of a document are never features.

``judge`` also says whether a text fits the language that it was given. A text's fit is the mean
log-probability of its trigrams in its family's model, plus ``SHORT`` over the root of their number,
as short texts scatter. A family's bound is the fit that 1 % of all its held-out labelled documents fall
short of (the families rightly predicted; with ``per_language`` at most so many of each language), less
``MARGIN``. Noise and languages never learned lie below it. A family with fewer than ``LEAST_HELD``
such documents has no bound, and without any labelled rows every text with a letter fits.

Cases: a null text or one without a letter is ``und`` with score 0; without any labelled rows
all are ``und``; a row with a null id is not learned from and not held out; repeated rows are
judged alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import lists, slices, utf8

DIMS = 1 << 14
#: Documents of a language in a shard, and tasks that train shards at most: each sends on a vector a language and machine.
SHARD_ROWS, SHARD_TASKS = 1000, 512
MAX_LANGUAGES = 400
UNKNOWN = "und"
#: Of ``judge``: nats a trigram, by which texts may be worse than the 1 % of held-out rows; slack of short texts.
MARGIN = 1.5
SHORT = 16.0
LEAST_HELD = 20

# Families of languages by ISO 639-1 code; any other language is a family by itself.
FAMILIES = {
    "germanic": "da de en fy is lb nl no nb nn sv yi af".split(),
    "romance": "ca es fr gl it oc pt ro".split(),
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk".split(),
    "baltic": "lt lv".split(),
    "uralic": "et fi hu".split(),
    "turkic": "az kk ky tr tk uz".split(),
    "semitic": "ar he mt".split(),
    "indo-aryan": "bn gu hi mr ne pa ur".split(),
    "dravidian": "kn ml ta te".split(),
    "celtic": "br cy ga gd".split(),
}
_FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}

_LETTER = regex.compile(r"\p{L}")
#: ASCII bytes that are no letters become spaces; letters are lower-cased.
_PLAIN = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(128)) + bytes(range(128, 256))
_SLOT = np.uint32(2654435761)


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], f"only {lang}")


def trigram_counts(text: bytes) -> np.ndarray:
    """Counts of hashed byte trigrams of a whole text, white space and digits and marks as spaces."""
    plain = b" %b " % b" ".join(text.lower().translate(_PLAIN).split())
    b = np.frombuffer(plain, dtype=np.uint8).astype(np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return np.bincount((code * _SLOT) >> np.uint32(18), minlength=DIMS)


def unit(counts: np.ndarray) -> np.ndarray:
    """Rows of square roots of counts, each of length one."""
    x = np.sqrt(counts)
    x /= np.maximum(np.sqrt(np.einsum("...i,...i->...", x, x))[..., None], 1e-12)
    return x


#: A document's features: the trigrams that it has, and how often.
Sparse = tuple[np.ndarray, np.ndarray]


def train_svm(rows: list[Sparse], y: np.ndarray, c: float = 1.0, epochs: int = 30, tolerance: float = 0.01) -> np.ndarray:
    """Linear SVM with squared hinge loss by dual coordinate descent; the last weight is the bias.

    Rows are (features, values) of unit length. An epoch in which no gradient exceeds
    ``tolerance`` is the last.
    """
    rows = [(np.append(i, DIMS), np.append(x, 1.0)) for i, x in rows]
    w, alpha = np.zeros(DIMS + 1), np.zeros(len(rows))
    # Both classes weigh the same.
    cost = c * len(y) / (2 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
    norm = np.array([x @ x for _, x in rows]) + 0.5 / cost
    order = np.random.default_rng(42)
    for _ in range(epochs):
        worst = 0.0
        for k in order.permutation(len(rows)):
            i, x = rows[k]
            gradient = y[k] * w[i].dot(x) - 1 + alpha[k] * 0.5 / cost[k]
            new = max(0.0, alpha[k] - gradient / norm[k])
            if new != alpha[k]:
                worst = max(worst, abs(gradient))
                w[i] += ((new - alpha[k]) * y[k]) * x
                alpha[k] = new
        if worst < tolerance:
            break
    return w


def train_pairs(langs: list[str], rows: list[Sparse]) -> dict[tuple[str, str], tuple[np.ndarray, float]]:
    """The machine of each two languages of a family that have rows, and the harmonic mean of their rows' numbers."""
    units = [(i, np.sqrt(n) / max(np.sqrt(n.sum()), 1e-12)) for i, n in rows]
    lang, out = np.array(langs), {}
    for a, b in combinations(sorted(set(langs)), 2):
        if family_of(a) == family_of(b):
            chosen = np.flatnonzero((lang == a) | (lang == b))
            y = np.where(lang[chosen] == a, 1.0, -1.0)
            weight = 2 / (1 / (y > 0).sum() + 1 / (y < 0).sum())
            out[a, b] = train_svm([units[k] for k in chosen], y), weight
    return out


class Discriminator:
    """Families by naive Bayes, the languages of a family by one-versus-one machines."""

    def __init__(self, langs: list[str], rows: list[Sparse]):
        names = sorted(set(langs))
        lang = np.array([names.index(x) for x in langs], dtype=np.int64)
        per_lang = np.zeros((len(names), DIMS))
        for k, (i, n) in zip(lang, rows):
            per_lang[k, i] += n
        machines = {(names.index(a), names.index(b)): w for (a, b), (w, _) in train_pairs(langs, rows).items()}
        self._set(names, per_lang, machines)

    @classmethod
    def of_sums(cls, sums: dict[str, np.ndarray], machines: dict[tuple[str, str], np.ndarray]) -> "Discriminator":
        """From the trigrams of each language and the machines of its pairs, both of whole tables."""
        model, names = cls.__new__(cls), sorted(sums)
        found = {(names.index(a), names.index(b)): w for (a, b), w in machines.items()}
        model._set(names, np.stack([sums[x] for x in names]), found)
        return model

    def _set(self, langs: list[str], per_lang: np.ndarray, machines: dict[tuple[int, int], np.ndarray]) -> None:
        self.langs = langs
        self.families = sorted({family_of(x) for x in self.langs})
        self.members = [[i for i, x in enumerate(self.langs) if family_of(x) == f] for f in self.families]
        # Languages of a family weigh the same, so do families.
        per_lang = per_lang / np.maximum(per_lang.sum(axis=1, keepdims=True), 1)
        log_p = np.stack([np.log(per_lang[m].mean(axis=0) + 1e-7) for m in self.members])
        self.log_p = (log_p - np.log(np.exp(log_p).sum(axis=1, keepdims=True))).astype(np.float32)
        self.least = np.full(len(self.families), -np.inf)
        none = np.zeros(DIMS + 1)
        self.machines = {p: machines.get(p, none).astype(np.float32) for m in self.members for p in combinations(m, 2)}

    def fit(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The family of each row, and how well its trigrams fit it."""
        log_family, n = counts @ self.log_p.T, np.maximum(counts.sum(axis=1), 1)
        return log_family.argmax(axis=1), log_family.max(axis=1) / n + SHORT / np.sqrt(n)

    def bound(self, langs: list[str], rows: list[Sparse]) -> None:
        """Set each family's least fit from labelled rows that were not learned from."""
        found = [[] for _ in self.families]
        for lang, (i, n) in zip(langs, rows):
            counts = np.zeros((1, DIMS), dtype=np.float32)
            counts[0, i] = n
            family, x = self.fit(counts)
            if self.families[family[0]] == family_of(lang):
                found[family[0]].append(x[0])
        for f, x in enumerate(found):
            if len(x) >= LEAST_HELD:
                self.least[f] = np.quantile(x, 0.01) - MARGIN

    def fits(self, counts: np.ndarray) -> np.ndarray:
        family, x = self.fit(counts)
        return x >= self.least[family]

    def predict(self, counts: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The language and a score from 0 to 1 of each row."""
        log_family = counts @ self.log_p.T
        p = np.exp(log_family - log_family.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        family = p.argmax(axis=1)
        score = p.max(axis=1)
        x = unit(counts)
        best = np.zeros(len(counts), dtype=np.int64)
        for f, m in enumerate(self.members):
            rows = np.flatnonzero(family == f)
            if not len(rows):
                continue
            votes = np.zeros((len(rows), len(m)))
            for a, b in combinations(m, 2):
                w = self.machines[a, b]
                margin = x[rows] @ w[:-1] + w[-1]
                # A vote, and a share below one vote by the margin for ties.
                side = np.tanh(margin) / (4 * len(m))
                votes[:, m.index(a)] += (margin >= 0) + side
                votes[:, m.index(b)] += (margin < 0) - side
            top = votes.argmax(axis=1)
            best[rows] = np.array(m)[top]
            if len(m) > 1:
                sure = np.full(len(rows), np.inf)
                for a, b in combinations(m, 2):
                    w = self.machines[a, b]
                    margin = x[rows] @ w[:-1] + w[-1]
                    sure = np.where(best[rows] == a, np.minimum(sure, margin), sure)
                    sure = np.where(best[rows] == b, np.minimum(sure, -margin), sure)
                score[rows] *= 1 / (1 + np.exp(-4 * np.clip(sure, -20, 20)))
        return [self.langs[i] for i in best], np.clip(score, 0.0, 1.0)


def _features(batches: Iterator[pa.RecordBatch], schema: pa.Schema):
    for batch in slices(batches):
        index, counts, sizes = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)], []
        for text in utf8(batch, "text"):
            c = trigram_counts(text or b"")
            at = np.flatnonzero(c)
            index.append(at)
            counts.append(c[at])
            sizes.append(len(at))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("lang"),
                lists(np.concatenate(index).astype(np.int32), sizes, pa.int32()),
                lists(np.concatenate(counts).astype(np.int32), sizes, pa.int32()),
            ],
            schema=schema,
        )


def held_out(doc_id):
    """Whether crc32 of the id as text is a multiple of five."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _by_language(col: Column, bounds: dict) -> Column:
    """The value of each row's language; null where there is none."""
    out = F.when(col == next(iter(bounds)), next(iter(bounds.values())))
    for lang, h in list(bounds.items())[1:]:
        out = out.when(col == lang, h)
    return out


def hash_limits(keyed: DataFrame, k: int) -> dict[str, int]:
    """The ``k``-th smallest hash of each language of (lang, h) rows; its greatest where there are fewer.

    Hashes of different ids are spread evenly, so a language with ``n`` rows has about ``k`` below the ``k / n``-th part
    of their range. Only rows below a bound somewhat above that are ranked, some ``k`` a language however large
    the table is; repeated hashes are counted before they meet. A language with too few rows there (as ids repeat) is
    tried again with a wider bound.
    """
    counts = {r["lang"]: r["n"] for r in keyed.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} different languages to learn")
    limits, part = {}, {lang: (k + 6 * k**0.5 + 10) / n for lang, n in counts.items()}
    while left := [lang for lang in sorted(counts) if lang not in limits]:
        bounds = {lang: min(int(part[lang] * (1 << 64)), (1 << 64) - 1) - (1 << 63) for lang in left}
        below = keyed.where(F.col("h") <= _by_language(F.col("lang"), bounds)).groupBy("lang", "h").agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("lang").orderBy("h"))
        first = below.withColumn("upto", upto).where(F.col("upto") - F.col("n") < k)
        for r in first.groupBy("lang").agg(F.max("h").alias("h"), F.sum("n").alias("n")).collect():
            if r["n"] >= min(k, counts[r["lang"]]):
                limits[r["lang"]] = r["h"]
        part = {lang: 8 * part[lang] for lang in left}
    return limits


def _sample(docs: DataFrame, held: bool, per_language: int) -> tuple[list[str], list[Sparse]]:
    """The languages and features of labelled documents that are held out, or that are not."""
    here = held_out(docs["doc_id"]) if held else ~held_out(docs["doc_id"])
    usable = docs.where(docs["lang"].isNotNull() & docs["doc_id"].isNotNull() & here)
    keyed = usable.select("lang", F.xxhash64(usable["doc_id"]).alias("h"), "text")
    limits = hash_limits(keyed.select("lang", "h"), per_language)
    if not limits:
        return [], []
    chosen = F.col("h") <= _by_language(F.col("lang"), limits)
    sample = keyed.where(chosen & F.col("text").isNotNull()).dropDuplicates(["lang", "h"])
    schema = pa.schema([("lang", pa.string()), ("i", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))])
    found = sample.select("lang", "text").mapInArrow(
        lambda it: _features(it, schema), "lang string, i array<int>, n array<int>"
    )
    table = found.toArrow()
    langs = table.column("lang").to_pylist()
    rows = [
        (np.array(i, dtype=np.int64), np.array(n, dtype=np.float64))
        for i, n in zip(table.column("i").to_pylist(), table.column("n").to_pylist())
    ]
    # The order of rows in the sample must not matter.
    order = sorted(range(len(langs)), key=lambda k: (langs[k], rows[k][0].tobytes(), rows[k][1].tobytes()))
    return [langs[k] for k in order], [rows[k] for k in order]


def _labelled(docs: DataFrame, held: bool) -> DataFrame:
    here = held_out(docs["doc_id"]) if held else ~held_out(docs["doc_id"])
    return docs.where(docs["lang"].isNotNull() & docs["doc_id"].isNotNull() & docs["text"].isNotNull() & here)


def _shard_features(batches: Iterator[pa.RecordBatch], schema: pa.Schema):
    """A row's language and shards, and its text's trigrams as bytes."""
    for batch in slices(batches):
        found = [trigram_counts(t or b"") for t in utf8(batch, "text")]
        at = [np.flatnonzero(c) for c in found]
        index = pa.array([i.astype("<u2").tobytes() for i in at], pa.binary())
        counts = pa.array([c[i].astype("<u4").tobytes() for c, i in zip(found, at)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("shards"), index, counts], schema=schema)


def _learn_shards(batches: Iterator[pa.RecordBatch], schema: pa.Schema):
    """Of rows in the order of their shards: sums of each language and weighted sums of each machine, once a task."""
    sums: dict[str, np.ndarray] = {}
    machines: dict[tuple[str, str], list] = {}
    shard, rows = None, []

    def learn() -> None:
        # The order of rows in a shard must not matter.
        rows.sort()
        sparse = [(np.frombuffer(i, "<u2").astype(np.int64), np.frombuffer(n, "<u4").astype(np.float64)) for _, i, n, _ in rows]
        for (lang, _, _, first), (i, n) in zip(rows, sparse):
            if first:
                sums.setdefault(lang, np.zeros(DIMS))[i] += n
        for pair, (w, weight) in train_pairs([r[0] for r in rows], sparse).items():
            total = machines.setdefault(pair, [np.zeros(DIMS + 1), 0.0])
            total[0] += weight * w
            total[1] += weight

    for batch in batches:
        for key, lang, first, i, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "lang", "first", "i", "n"))):
            if key != shard and rows:
                learn()
                rows = []
            shard = key
            rows.append((lang, i, n, first))
    if rows:
        learn()
    task = TaskContext.get().partitionId()
    found = [(x, None, 0.0, v.tobytes()) for x, v in sums.items()]
    found += [(a, b, weight, w.tobytes()) for (a, b), (w, weight) in machines.items()]
    if found:
        a, b, weight, v = map(list, zip(*found))
        yield pa.RecordBatch.from_arrays(
            [pa.array([task] * len(a), pa.int32()), pa.array(a), pa.array(b, pa.string()), pa.array(weight), pa.array(v, pa.binary())],
            schema=schema,
        )


def _add_vectors(key, found):
    """The sums of tasks' vectors of one language or machine, in the order of the tasks."""
    import pandas as pd

    found = found.sort_values("task")
    total = sum(np.frombuffer(v) for v in found["v"])
    return pd.DataFrame({"a": [key[0]], "b": [key[1]], "weight": [found["weight"].sum()], "v": [total.tobytes()]})


def _train_on_all(docs: DataFrame, shard_rows: int) -> Discriminator | None:
    rows = _labelled(docs, False)
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} different languages to learn")
    if not counts:
        return None
    own = {x: -(-n // shard_rows) for x, n in counts.items()}
    most: dict[str, int] = {}
    for x, n in own.items():
        most[family_of(x)] = max(most.get(family_of(x), 1), n)
    # A language with fewer shards than its family's largest is in every so many of them; the first counts its trigrams.
    first = F.pmod(F.xxhash64(rows["doc_id"], rows["text"]), _by_language(rows["lang"], own))
    last = _by_language(rows["lang"], {x: most[family_of(x)] - 1 for x in own})
    shards = F.sequence(first, last.cast("long"), _by_language(rows["lang"], own).cast("long"))
    schema = pa.schema([("lang", pa.string()), ("shards", pa.list_(pa.int64())), ("i", pa.binary()), ("n", pa.binary())])
    features = rows.select("lang", shards.alias("shards"), "text").mapInArrow(
        lambda it: _shard_features(it, schema), "lang string, shards array<long>, i binary, n binary"
    )
    family = _by_language(F.col("lang"), {x: family_of(x) for x in own})
    dealt = features.select("lang", "i", "n", F.posexplode("shards").alias("at", "j")).select(
        F.concat_ws(" ", family, F.col("j").cast("string")).alias("shard"), "lang", (F.col("at") == 0).alias("first"), "i", "n"
    )
    tasks = min(sum(most.values()), SHARD_TASKS)
    sent = pa.schema([("task", pa.int32()), ("a", pa.string()), ("b", pa.string()), ("weight", pa.float64()), ("v", pa.binary())])
    parts = dealt.repartition(tasks, "shard").sortWithinPartitions("shard").mapInArrow(
        lambda it: _learn_shards(it, sent), "task int, a string, b string, weight double, v binary"
    )
    found = parts.groupBy("a", "b").applyInPandas(_add_vectors, "a string, b string, weight double, v binary").collect()
    vectors = {(r["a"], r["b"]): (np.frombuffer(bytes(r["v"])), r["weight"]) for r in found}
    return Discriminator.of_sums(
        {a: v for (a, b), (v, _) in vectors.items() if b is None},
        {(a, b): v / weight for (a, b), (v, weight) in vectors.items() if b is not None},
    )


def _fits_of_held(batches: Iterator[pa.RecordBatch], model: Discriminator, schema: pa.Schema):
    """The family and fit of each text whose family is rightly predicted."""
    for batch in slices(batches, PREDICT_ROWS):
        counts = np.stack([trigram_counts(t or b"").astype(np.float32) for t in utf8(batch, "text")])
        family, fit = model.fit(counts)
        right = np.array([model.families[f] == family_of(x) for f, x in zip(family, batch.column("lang").to_pylist())])
        yield pa.RecordBatch.from_arrays(
            [pa.array(family[right].astype(np.int32)), pa.array(fit[right].astype(np.float64))], schema=schema
        )


def _bound_by_all(model: Discriminator, docs: DataFrame) -> None:
    """``Discriminator.bound`` by all held-out rows; their quantile is within a ten-thousandth of the ranks."""
    schema = pa.schema([("family", pa.int32()), ("fit", pa.float64())])
    fits = _labelled(docs, True).select("lang", "text").mapInArrow(
        lambda it: _fits_of_held(it, model, schema), "family int, fit double"
    )
    least = F.percentile_approx("fit", 0.01, 10_000).alias("least")
    for r in fits.groupBy("family").agg(least, F.count(F.lit(1)).alias("n")).collect():
        if r["n"] >= LEAST_HELD:
            model.least[r["family"]] = r["least"] - MARGIN


def train(
    docs: DataFrame, per_language: int | None = None, judge: bool = False, shard_rows: int = SHARD_ROWS
) -> Discriminator | None:
    """Learn from the labelled documents that are not held out; None if there are none."""
    if per_language is None:
        model = _train_on_all(docs, shard_rows)
        if model and judge:
            _bound_by_all(model, docs)
        return model
    langs, rows = _sample(docs, False, per_language)
    if not langs:
        return None
    model = Discriminator(langs, rows)
    del langs, rows
    if judge:
        model.bound(*_sample(docs, True, per_language))
    return model


#: Rows whose dense features a task holds at once.
PREDICT_ROWS = 64


def _predict(batches: Iterator[pa.RecordBatch], model: Discriminator | None, judge: bool, kept: int, schema: pa.Schema):
    """The first ``kept`` columns are those of the result."""
    for batch in slices(batches, PREDICT_ROWS):
        texts = utf8(batch, "text")
        known = [k for k, t in enumerate(texts) if t and _LETTER.search(t.decode())]
        lang, score, fits = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
        fits[known] = True
        if known and model:
            counts = np.stack([trigram_counts(texts[k]).astype(np.float32) for k in known])
            found, sure = model.predict(counts)
            score[known] = sure
            if judge:
                fits[known] = model.fits(counts)
            for k, x in zip(known, found):
                lang[k] = x
        judged = [pa.array(fits)] if judge else []
        yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array(lang), pa.array(score), *judged], schema=schema)


#: The columns of the result.
NAMES = ("lang_pred", "score", "lang_fits")


def identify_languages(
    docs: DataFrame,
    keep: list[str] | None = None,
    per_language: int | None = None,
    judge: bool = False,
    names: tuple[str, str, str] = NAMES,
) -> DataFrame:
    """The columns ``keep`` (default: doc_id) with lang_pred and score, and lang_fits with ``judge``.

    ``names`` are the names of these three, for tables that have such columns already.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    keep = list(keep or ["doc_id"])
    model = train(docs, per_language, judge)
    inputs = docs.select(*dict.fromkeys([*keep, "text"]))
    out = inputs.select(*keep).schema.add(names[0], "string").add(names[1], "double")
    out = out.add(names[2], "boolean") if judge else out
    schema = to_arrow_schema(out)
    return inputs.mapInArrow(lambda it: _predict(it, model, judge, len(keep), schema), out)
