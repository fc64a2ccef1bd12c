"""Token counts by a linear longest-match automaton over a word-piece vocabulary.

The vocabulary is a trie. Each node has a failure link and the number of pieces that are
popped on the way over it: where a text leaves the trie, the longest-match pieces of what has
been read are already known to the node, so only their number is added and reading goes on
at the link, never going back in the text. A word's greedy longest-match length thus takes
one step a character plus one a popped link, and no piece is built.

Pieces that start a word carry the mark ``▁``; all others continue one. A word (a run of
characters that are not ASCII white space) is cut greedily; where no piece begins, one character
counts as its UTF-8 bytes, for which the vocabulary has a piece each, and cutting goes on behind
it. ``n_unknown`` is the number of words with such a character. With a given vocabulary that has
no byte pieces such a word counts as one unknown token, as word-piece tokenizers have it.

Cases: a null or empty text has no words; very long words and texts cost in proportion to
their length; repeated rows are counted alike; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType

from affinity.llm.common import slices

START = "▁"
#: Added to a count for each character counted by its bytes, or each unknown word; a text has fewer tokens.
UNKNOWN = 1 << 40
#: Bytes of words whose lengths a task remembers: ``ENTRY_BYTES`` each and what their characters take at most. Words
#: longer than ``CACHE_CHARS`` are counted anew in each text.
CACHE_BYTES = 96 << 20
ENTRY_BYTES = 200
CACHE_CHARS = 64
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def default_vocabulary() -> list[str]:
    import public_tokenizers

    return read_pieces(public_tokenizers.path("piece_bpe_32k.model"))


def read_pieces(path: str) -> list[str]:
    """The ordinary pieces of a sentence-piece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


def has_byte_pieces(path: str) -> bool:
    """Whether a sentence-piece model file has a piece for each byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return sum(map(model.is_byte, range(model.get_piece_size()))) == 256


def _by_bytes(c: str) -> int:
    return len(c.encode("utf-8", "surrogatepass")) + UNKNOWN


class LongestMatch:
    """Nodes are numbers; 0 is the root, from which both words and their later pieces are read.

    With ``by_bytes`` a character at which no piece begins counts as its UTF-8 bytes.
    """

    def __init__(self, pieces: Iterable[str], start: str = START, by_bytes: bool = False):
        self.start, self.by_bytes = start, by_bytes
        self.next: list[dict[str, int]] = [{}]
        ends = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    ends.append(False)
                node = self.next[node][c]
            ends[node] = node > 0
        self.link: list[int] = [-1] * len(self.next)
        self.popped = [0] * len(self.next)
        queue = deque([0])
        while queue:
            up = queue.popleft()
            for c, node in self.next[up].items():
                queue.append(node)
                if ends[node]:
                    self.link[node], self.popped[node] = 0, 1
                    continue
                at, count = self.link[up], self.popped[up]
                while at >= 0 and c not in self.next[at]:
                    count += self.popped[at]
                    at = self.link[at]
                if at >= 0:
                    self.link[node], self.popped[node] = self.next[at][c], count
                elif by_bytes:
                    self.link[node], self.popped[node] = 0, count + _by_bytes(c)

    def length(self, word: str) -> int:
        """The number of greedy pieces of a word; -1 if it has none."""
        n = self.cut(word)
        return n if n < 0 else n % UNKNOWN

    def cut(self, word: str) -> int:
        """The same, and ``UNKNOWN`` for each character that counts by its bytes."""
        step, link, popped = self.next, self.link, self.popped
        node = count = 0
        for c in self.start + word:
            while (to := step[node].get(c)) is None:
                if link[node] < 0:
                    if not self.by_bytes:
                        return -1
                    # Only the root has no link; the character is passed there.
                    count += _by_bytes(c)
                    to = 0
                    break
                count += popped[node]
                node = link[node]
            node = to
        while node:
            if link[node] < 0:
                return -1
            count += popped[node]
            node = link[node]
        return count


class WordLengths:
    """Lengths of words, with those of short ones remembered up to a number of bytes."""

    def __init__(self, automaton: LongestMatch):
        self.cut = automaton.cut
        self.seen: dict[str, int] = {}
        self.held = 0

    def total(self, words: list[str]) -> tuple[int, int]:
        """The tokens of a text's words, and how many of the words are unknown."""
        seen = self.seen
        new = set(words).difference(seen)
        for w in new:
            n = self.cut(w)
            # A word is unknown once, however many such characters it has.
            seen[w] = 1 + UNKNOWN if n < 0 else n if n < UNKNOWN else n % UNKNOWN + UNKNOWN
        unknown, tokens = divmod(sum(map(seen.__getitem__, words)), UNKNOWN)
        for w in new:
            if len(w) > CACHE_CHARS:
                del seen[w]
            else:
                self.held += ENTRY_BYTES + 4 * len(w)
        if self.held > CACHE_BYTES:
            self.seen, self.held = {}, 0
        return tokens, unknown


def _count(batches: Iterator[pa.RecordBatch], pieces: list[str], by_bytes: bool, schema: pa.Schema):
    lengths = WordLengths(LongestMatch(pieces, by_bytes=by_bytes))
    for batch in slices(batches):
        rows = []
        for text in batch.column("text").to_pylist():
            words = _WORD.findall(text or "")
            rows.append((len(words), *lengths.total(words)))
        keep = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] != "text"]
        counts = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
        yield pa.RecordBatch.from_arrays([*keep, *counts], schema=schema)


def count_tokens(docs: DataFrame, pieces: list[str] | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown of every text.

    A vocabulary given as ``pieces`` has no byte pieces; the default one's are used.
    """
    import public_tokenizers

    by_bytes = pieces is None and has_byte_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    pieces = pieces if pieces is not None else default_vocabulary()
    out = docs.select("doc_id").schema
    for name in ("n_words", "n_tokens", "n_unknown"):
        out = out.add(name, LongType())
    schema = to_arrow_schema(out)
    return docs.select("doc_id", "text").mapInArrow(lambda it: _count(it, pieces, by_bytes, schema), out)
