"""Mixture-controlled packing: deficit round-robin over source queues.

Every source is a queue: the stream of its documents' ids, each document closed by an end
id. A queue's stream is served in slots of ``slot_tokens`` ids. Queue ``s`` with target
weight ``w_s`` earns ``w_s`` per unit of time and pays for a slot when its deficit has grown
to half of one, so its slot ``j`` is due at ``(2 j + 1) / w_s``; slots are laid in the order
in which they are due (ties: the queue's number). A window is the next
``window_tokens / slot_tokens`` slots of that order, so every window carries the targets to
within one slot a queue, and what a queue is owed goes on to the next window. A queue that
has run dry stops, and the others share what it leaves. The part of each queue that is
shorter than a slot comes at the end of the order, so all windows but the last are full.

The order is known in closed form: the place of slot ``j`` of queue ``s`` is the number of
slots of all queues that are due before it, a few integer operations a queue. So a task
needs only where each of its documents starts in its queue. That is a prefix sum: running
sums inside each partition while it is tokenised, then the partitions' totals (one row for
each queue and partition). Deficits thus carry over partitions without any sequential pass,
and a queue with a third of all rows is spread over as many tasks as its rows are.

Cases: a null text counts as empty and is the end id alone; a null source is a queue of its
own; repeated rows are separate documents; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinity.llm.common import slices
from affinity.session import write_stage

#: With more sources than this the largest half of so many and those named in targets keep queues of their own; the
#: rest share the other half by their hash, which bounds the table of queues.
MAX_QUEUES = 1024
#: Target weights are whole parts of this.
WEIGHT_PARTS = 1 << 20
#: Bytes of words and their ids that a task remembers in each of two generations; the older one is dropped when the
#: younger is full. ``ENTRY_BYTES`` is what a remembered word costs beside its characters; longer words than
#: ``CACHE_CHARS`` are encoded anew each time.
CACHE_BYTES = 40 << 20
ENTRY_BYTES = 180
CACHE_CHARS = 64

_WORD = re.compile(r" (?=\S)")


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class WordIds:
    """Ids of whole texts of a byte-level BPE vocabulary, with the ids of seen words kept.

    Byte-level BPE never merges over the start of a word (a space before a character that
    is no space), so the ids of a text are those of its words in turn. Unseen words are
    encoded together and their ids dealt out by the ids' byte lengths. The vocabulary is the
    tokenizer file's; the merges of such a vocabulary are its ids in ascending order, which
    the constructor checks. Strings of special tokens in a text are their tokens, as the file's
    library has it, and part the text before words are cut.
    """

    def __init__(self, tokenizer_json: str):
        import json

        import tiktoken

        spec = json.loads(tokenizer_json)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        # Byte-level BPE shows the printable bytes as themselves, others from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown}
        byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        made = [vocab[a + b] for a, b in pairs]
        if made != sorted(made) or len(ranks) != 256 + len(made) or max([*ranks.values(), *special.values()]) >= 1 << 16:
            raise ValueError("not a byte-level BPE vocabulary with ids in merge order below 65536")
        # Fixed value: the pre-tokenizing pattern of byte-level BPE.
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self._encode = tiktoken.Encoding(
            "byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self._length = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            self._length[i] = len(token)
        self._special = {t: array("H", [i]).tobytes() for t, i in special.items()}
        longest_first = sorted(map(re.escape, special), key=len, reverse=True)
        self._cut = re.compile(f"({'|'.join(longest_first)})") if special else None
        self._seen: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._held = 0

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        ids = np.array(self._encode(" " + " ".join(words)), dtype="<u2")
        ends = np.cumsum(self._length[ids])
        word_ends = np.cumsum([len(w.encode()) + 1 for w in words])
        cuts = np.searchsorted(ends, word_ends, side="right").tolist()
        raw, lo, fresh = ids.tobytes(), 0, {}
        for w, hi in zip(words, cuts):
            fresh[w] = raw[2 * lo : 2 * hi]
            lo = hi
        self._remember({w: i for w, i in fresh.items() if len(w) <= CACHE_CHARS})
        return fresh

    def _remember(self, words: dict[str, bytes]) -> None:
        self._seen.update(words)
        self._held += sum(ENTRY_BYTES + len(w) + len(i) for w, i in words.items())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 16-bit ids of each text."""
        if not self._special or not any(s in t for t in texts for s in self._special):
            return self._encode_plain(texts)
        # Between special strings lie texts of their own.
        parts = [self._cut.split(t) for t in texts]
        plain = iter(self._encode_plain([p for row in parts for p in row[::2]]))
        ids = [[self._special[p] if k % 2 else next(plain) for k, p in enumerate(row)] for row in parts]
        return [b"".join(row) for row in ids]

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        split = [_WORD.split(t) for t in texts]
        # A text's first piece has no space before it.
        first = [array("H", self._encode(p[0])).tobytes() if p[0] else b"" for p in split]
        if self._held > CACHE_BYTES:
            self._seen, self._older, self._held = {}, self._seen, 0
        seen, older = self._seen, self._older
        found = [list(map(seen.get, p[1:])) for p in split]
        missing = {w for p, f in zip(split, found) for w, i in zip(p[1:], f) if i is None}
        if missing:
            known = {w: older[w] for w in missing & older.keys()}
            self._remember(known)
            fresh = self._learn(list(missing - known.keys())) | known if len(known) < len(missing) else known
            found = [[fresh[w] if i is None else i for w, i in zip(p[1:], f)] for p, f in zip(split, found)]
        return [b"".join(chain((a,), f)) for a, f in zip(first, found)]


def queue_of(source, shared: int = 0, own: Iterable[str] = ()):
    """The queue's name: the source itself, or one of ``shared`` where the source is not in ``own``."""
    name = F.coalesce(F.concat(F.lit("="), source), F.lit("null"))
    pooled = F.concat(F.lit("#"), F.pmod(F.xxhash64(name), F.lit(shared)))
    return F.when(name.isin(*own), name).otherwise(pooled) if shared else name


def largest_queues(docs: DataFrame, source, n: int) -> list[str]:
    """The queues of the ``n`` sources with most characters, an end a document included, by an exact count."""
    size = F.length(F.coalesce(docs["text"], F.lit(""))) + F.lit(1)
    sizes = docs.select(queue_of(source).alias("queue"), size.alias("n")).groupBy("queue").agg(F.sum("n").alias("n"))
    return [r["queue"] for r in sizes.orderBy(F.desc("n"), "queue").limit(n).collect()]


def _tokenise(batches: Iterator[pa.RecordBatch], tokenizer_json: str, end_id: int, schema: pa.Schema):
    encoder = WordIds(tokenizer_json)
    part, served = TaskContext.get().partitionId(), {}
    end = array("H", [end_id]).tobytes()
    for batch in slices(batches):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        ids = [i + end for i in encoder.encode(texts)]
        counts, starts = [len(i) // 2 for i in ids], []
        for q, n in zip(batch.column("queue").to_pylist(), counts):
            starts.append(served.get(q, 0))
            served[q] = starts[-1] + n
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("queue"),
                pa.array([part] * len(ids), pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array(ids, pa.binary()),
            ],
            schema=schema,
        )


def slot_places(queue: np.ndarray, slot: np.ndarray, weights: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The place of slot ``slot[i]`` of queue ``queue[i]`` in the order of all queues' slots."""
    place = np.zeros(len(slot), dtype=np.int64)
    mine = (2 * slot + 1).astype(np.int64)
    own = weights[queue]
    for r in range(len(weights)):
        # Slots i of r with (2 i + 1) / w_r < (2 j + 1) / w_s, or equal where r comes first.
        due = mine * weights[r]
        last = np.where(r < queue, due, due - 1) // own
        place += np.minimum((last + 1) // 2, slots[r])
    return place


def lay_pieces(
    queue: np.ndarray,
    start: np.ndarray,
    length: np.ndarray,
    weights: np.ndarray,
    totals: np.ndarray,
    slot_tokens: int,
    window_tokens: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents (queue, start in the queue, length) -> pieces (document, start in it, length, sequence, offset)."""
    g = slot_tokens
    slots, tails = totals // g, totals % g
    first, last = start // g, (start + length - 1) // g
    n = last - first + 1
    doc = np.repeat(np.arange(len(start)), n)
    slot = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    q = queue[doc]
    lo = np.maximum(slot * g, start[doc])
    hi = np.minimum((slot + 1) * g, (start + length)[doc])
    place = np.empty(len(doc), dtype=np.int64)
    full = slot < slots[q]
    place[full] = slot_places(q[full], slot[full], weights, slots) * g
    before = slots.sum() * g + np.cumsum(tails) - tails
    place[~full] = before[q[~full]]
    at = place + lo - slot * g
    size = hi - lo
    # A run of a document that lies in one stretch of one sequence is one piece.
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + size[:-1]) | (at[1:] % window_tokens == 0)
    # The shared tail at the end may run over a window's end.
    piece = np.flatnonzero(new)
    doc, lo, at = doc[piece], lo[piece], at[piece]
    size = np.add.reduceat(size, piece) if len(piece) else size
    room = window_tokens - at % window_tokens
    over = size > room
    if over.any():
        k = np.flatnonzero(over)
        doc = np.concatenate([doc, doc[k]])
        lo = np.concatenate([lo, lo[k] + room[k]])
        at = np.concatenate([at, at[k] + room[k]])
        rest = size[k] - room[k]
        size = np.concatenate([np.minimum(size, room), rest])
        order = np.lexsort((lo, doc))
        doc, lo, at, size = doc[order], lo[order], at[order], size[order]
    return doc, lo - start[doc], size, at // window_tokens, at % window_tokens


def _lay(batches, names: dict[str, int], weights, totals, slot_tokens, window_tokens, schema):
    for batch in slices(batches, 64):
        queue = np.array([names[q] for q in batch.column("queue").to_pylist()], dtype=np.int64)
        start = batch.column("start").to_numpy(zero_copy_only=False)
        length = batch.column("n").to_numpy(zero_copy_only=False)
        doc, lo, size, sequence, offset = lay_pieces(queue, start, length, weights, totals, slot_tokens, window_tokens)
        # Checked ids are unsigned 32-bit.
        ids = [np.frombuffer(i, dtype="<u2").astype("<u4").tobytes() for i in batch.column("ids").to_pylist()]
        crc = [zlib.crc32(ids[d][4 * a : 4 * (a + n)]) for d, a, n in zip(doc.tolist(), lo.tolist(), size.tolist())]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(doc)),
                pa.array(lo, pa.int64()),
                pa.array(size, pa.int64()),
                pa.array(crc, pa.int64()),
                pa.array(length[doc], pa.int64()),
                pa.array(sequence, pa.int64()),
                pa.array(offset, pa.int64()),
            ],
            schema=schema,
        )


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    targets: dict[str | None, float] | None = None,
    window_tokens: int = 1024,
    slot_tokens: int = 128,
    end_id: int = 0,
    max_queues: int = MAX_QUEUES,
) -> DataFrame:
    """Pack every document into sequences of ``window_tokens`` ids; one row a piece.

    ``targets`` gives the wanted token share of each source (default: the shares that the
    table has); sources that it does not name get what their own share is. Beyond ``max_queues``
    sources, small ones that ``targets`` does not name share queues and have one share together.
    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    """
    if window_tokens % slot_tokens:
        raise ValueError("window_tokens must be a multiple of slot_tokens")
    spark: SparkSession = docs.sparkSession
    tokenizer_json = Path(tokenizer_path or default_tokenizer_path()).read_text(encoding="utf-8")
    source = docs["source"].cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    named = docs.select(docs["doc_id"], queue_of(source).alias("queue"), docs["text"])
    few = named.select("queue").distinct().limit(max_queues + 1).count() <= max_queues
    wanted = {"null" if s is None else f"={s}": p for s, p in (targets or {}).items()}
    if not few:
        shared = max(1, max_queues // 2)
        own = {*wanted, *largest_queues(docs, source, max(1, max_queues - shared))}
        named = docs.select(docs["doc_id"], queue_of(source, shared, sorted(own)).alias("queue"), docs["text"])
    doc_type = named.schema["doc_id"].dataType.simpleString()
    id_type = pa.string() if doc_type == "string" else pa.int32() if doc_type == "int" else pa.int64()
    stage_schema = pa.schema(
        [("doc_id", id_type), ("queue", pa.string()), ("part", pa.int32()), ("start", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())]
    )
    staged = write_stage(
        named.mapInArrow(
            lambda it: _tokenise(it, tokenizer_json, end_id, stage_schema),
            f"doc_id {doc_type}, queue string, part int, start long, n long, ids binary",
        ),
        "pack_ids",
    )
    parts = write_stage(staged.groupBy("queue", "part").agg(F.sum("n").alias("n")), "pack_parts")
    sums = {r["queue"]: int(r["n"]) for r in parts.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    queues = sorted(sums)
    totals = np.array([sums[q] for q in queues], dtype=np.int64)
    share = totals / max(1, totals.sum())
    for name, p in wanted.items():
        if name in sums:
            share[queues.index(name)] = p
    weights = np.maximum(1, np.round(share * WEIGHT_PARTS)).astype(np.int64)
    names = {q: i for i, q in enumerate(queues)}

    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("queue", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = staged.join(before, ["queue", "part"]).withColumn("start", F.col("start") + F.col("before"))
    out = pa.schema(
        [("doc_id", id_type)]
        + [(c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    )
    return placed.select("doc_id", "queue", "start", "n", "ids").mapInArrow(
        lambda it: _lay(it, names, weights, totals, slot_tokens, window_tokens, out),
        f"doc_id {doc_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
