"""Secret scans behind a trigram inverted index, in DataFrame operations only.

1. Each rule's expression gives a Boolean query over trigrams (``trigram_query``).
2. Postings: for every trigram that some query asks for, the documents that hold it. Other
   trigrams are never looked up and are not stored.
3. Each rule's query is answered by intersecting and uniting its trigrams' postings: they
   meet by document, pre-aggregated in the task that made them, so one row a document is
   shuffled. The answers are candidate documents with the rules to verify.
4. Candidates meet their texts again, and each candidate rule's expression finds the spans.
   Rules without a mandatory trigram scan every text.

A document's key is the hash of its id and text. Two rows with one key share their candidate
rules, which is safe: verification decides. The candidates are a written table, so Spark
broadcasts them only when their files are small, and otherwise can split a hot key.

Positions: a text is split at the matches, and the lengths of pieces and matches add up to
code point positions, in blocks of ``BLOCK`` matches so that texts with very many matches
stay cheap.

Expressions have no repeated groups, on which Java's matcher recurses, and no unbounded run that could
begin at each of its own characters, so any text is scanned in steps in proportion to its length. What
follows a private key's BEGIN line is found in the piece behind the match: up to the END line, or line by line.

Cases: a null text counts as empty; repeated rows are scanned alike; an empty table gives no
rows; all other columns stay, and a column with the result's name is replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import free_names, in_blocks
from affinity.llm.common import let as _let
from affinity.llm.trigram_query import grams, trigram_query
from affinity.session import write_stage


@dataclass(frozen=True)
class SecretRule:
    """``least``: code points that the group must have; a match with fewer is dropped.

    ``tail`` gives the code points that belong to a match of the text behind it, up to the next match.
    """

    kind: str
    regex: str
    group: int = 0
    least: int = 1
    tail: Callable[[Column], Column] | None = None


BASE_RULES = (
    SecretRule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # A run of 24 or more is a match of [0-9a-f]+ that is long enough, and the reverse.
    SecretRule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: A private key: from its BEGIN line over the body to the END line, which is the next five hyphens. Without an
#: END line, header fields, blank lines and lines of base64 (17 characters or more, quoted and indented as they may
#: be) belong to it up to the last of base64, and a shorter line of base64 right behind that.
KEY_NAME = r"[A-Z\x20]*PRIVATE KEY(?: BLOCK)?-----"
KEY_END = f"^-----END {KEY_NAME}"
_LINE_END = r"(?:\\r\\n|\\[nr]|\r\n|\r|\n|\\)"
#: A line with its end, also where line ends are written as escapes.
KEY_LINE = rf"[^\r\n\\]*{_LINE_END}|[^\r\n\\]+"
BASE64 = r"^[\x20\t\"'>#*|,]*[A-Za-z0-9+/=]{17,}"
IS_BASE64 = rf"{BASE64}[\x20\t\"',+]*{_LINE_END}?\z"
IS_OTHER = rf"^[\x20\t]*(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset):\x20|^[\x20\t\"']*{_LINE_END}\z"
IS_SHORT = r"^[\x20\t]*[A-Za-z0-9+/=]{1,16}(?:[\r\n\\\"']|\z)"


def key_body(rest: Column) -> Column:
    """The length of a private key's body and END line at the beginning of ``rest``."""
    hyphens = F.instr(rest, F.lit("-----"))
    end = F.regexp_extract(F.substring(rest, hyphens, F.length(rest)), KEY_END, 0)
    lines = F.regexp_extract_all(rest, F.lit(KEY_LINE), F.lit(0))
    is_base64 = lambda x: x.rlike(IS_BASE64)

    def of_lines(lines: Column) -> Column:
        other = F.array_position(F.transform(lines, lambda x: is_base64(x) | x.rlike(IS_OTHER)), False)
        leading = F.slice(lines, F.lit(1), F.when(other > 0, other.cast("int") - 1).otherwise(F.size(lines)))
        behind = F.array_position(F.reverse(F.transform(leading, is_base64)), True).cast("int")
        last = F.size(leading) - behind + 1
        length = lambda xs: F.aggregate(xs, F.lit(0), lambda n, x: n + F.length(x))
        short = F.coalesce(F.get(lines, last), F.lit(""))
        return (
            F.when(behind == 0, 0)
            .when(short.rlike(IS_SHORT), length(F.slice(lines, F.lit(1), last)) + F.length(F.regexp_extract(short, IS_SHORT, 0)))
            .otherwise(
                length(F.slice(lines, F.lit(1), last - 1)) + F.length(F.regexp_extract(F.get(lines, last - 1), BASE64, 0))
            )
        )

    return F.when((hyphens > 0) & (end != ""), hyphens - 1 + F.length(end)).otherwise(_let(lines, of_lines))


#: Public token formats beyond the base.
MORE_RULES = (
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    SecretRule("google", r"AIza[0-9A-Za-z_-]{35}"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{10,1000}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    SecretRule("private_key", f"-----BEGIN {KEY_NAME}", tail=key_body),
    # Of a scheme the last 32 characters; none is longer.
    SecretRule("url_login", r"[A-Za-z][A-Za-z0-9+.-]{0,31}://[A-Za-z0-9._~%-]+:[A-Za-z0-9._~%!$&*+,;=-]+@"),
)
RULES = BASE_RULES + MORE_RULES


def _answer(query, known: Column, number: dict[str, int]) -> Column:
    if isinstance(query, str):
        return F.array_contains(known, number[query])
    parts = [_answer(p, known, number) for p in sorted(query[1], key=repr)]
    out = parts[0]
    for p in parts[1:]:
        out = out & p if query[0] == "and" else out | p
    return out


def postings(texts: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(key, text) -> (gram, key): the documents of each trigram of the vocabulary (by its number)."""
    folded = texts.select("key", F.lower("text").alias("folded"))
    held = F.array_compact(F.array(*(F.when(F.contains("folded", F.lit(g)), F.lit(i)) for i, g in enumerate(vocabulary))))
    return folded.select("key", F.explode(held).alias("gram"))


def candidate_documents(texts: DataFrame, rules: tuple[SecretRule, ...]) -> DataFrame:
    """(key, rules): the numbers of the rules whose query the document's trigrams satisfy."""
    queries = {i: q for i, r in enumerate(rules) if (q := trigram_query(r.regex)) is not True}
    vocabulary = sorted(set().union(*map(grams, queries.values())) if queries else ())
    if not vocabulary:
        return texts.sparkSession.createDataFrame([], "key long, rules array<int>")
    number = {g: i for i, g in enumerate(vocabulary)}
    met = postings(texts, vocabulary).groupBy("key").agg(F.collect_set("gram").alias("grams"))
    fits = F.array(*(F.when(_answer(q, F.col("grams"), number), F.lit(i)) for i, q in queries.items()))
    return met.select("key", F.array_compact(fits).alias("rules")).where(F.size("rules") > 0)


def _steps(text: Column, matches: Column, rule: SecretRule) -> Column:
    """For each match: code points before it since the last, its own, its group's, and those of its tail."""
    groups = matches if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group))
    pieces = F.split(text, rule.regex, -1)
    tails = F.transform(F.slice(pieces, F.lit(2), F.size(matches)), rule.tail or (lambda p: F.lit(0)))
    return F.zip_with(
        F.slice(pieces, F.lit(1), F.size(matches)),
        F.arrays_zip(F.transform(matches, F.length).alias("n"), F.transform(groups, F.length).alias("g"), tails.alias("tail")),
        lambda p, m: F.struct(F.length(p).alias("gap"), m["n"].alias("n"), m["g"].alias("g"), m["tail"].alias("tail")),
    )


def _positions(steps: Column, rule: SecretRule, number: int) -> Column:
    """Spans (start, end, kind) of the matches that are long enough."""
    span = "array<struct<start:int,end:int,kind:int>>"

    def of_block(acc, block):
        def add(a, s):
            start = a["at"] + s["gap"]
            end = start + s["n"] + s["tail"]
            mine = F.array(F.struct(start.alias("start"), end.alias("end"), F.lit(number).alias("kind")))
            grown = F.when(s["g"] >= rule.least, F.concat(a["out"], mine)).otherwise(a["out"])
            return F.struct((start + s["n"]).alias("at"), grown.alias("out"))

        none = F.struct(acc["at"].alias("at"), F.array().cast(span).alias("out"))
        inner = F.aggregate(block, none, add)
        return F.struct(inner["at"].alias("at"), F.concat(acc["out"], F.array(inner["out"])).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("out"))
    return F.flatten(F.aggregate(in_blocks(steps), start, of_block)["out"])


def find_secrets(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, name: str = "secret_spans") -> DataFrame:
    """The table with ``name``: spans (start, kind, end) by start, then kind; kind is the rule's number."""
    docs = docs.drop(*(c for c in docs.columns if c.lower() == name.lower()))
    k = len(rules)
    names = free_names([*docs.columns, name], ["secret_key", "secret_rules", *(f"secret_{x}{i}" for x in "mts" for i in range(k))])
    key, due, (found, steps, cut) = names[0], names[1], (names[2 + j * k : 2 + (j + 1) * k] for j in range(3))
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    candidates = write_stage(candidate_documents(keyed.select(F.col(key).alias("key"), text.alias("text")), rules), "secret_candidates")
    df = keyed.join(candidates.select(F.col("key").alias(key), F.col("rules").alias(due)), key, "left")
    spans = "array<struct<start:int,end:int,kind:int>>"
    asked = [F.lit(True) if trigram_query(r.regex) is True else F.array_contains(due, i) for i, r in enumerate(rules)]
    df = df.withColumns({c: F.when(a, F.regexp_extract_all(text, F.lit(r.regex), F.lit(0))) for c, a, r in zip(found, asked, rules)})
    # Each list is a column of its own that is used more than once, so Spark computes it once a row.
    df = df.withColumns({t: F.when(F.size(m) > 0, _steps(text, F.col(m), r)) for t, m, r in zip(steps, found, rules)})
    positions = (_positions(F.col(t), r, i) for i, (t, r) in enumerate(zip(steps, rules)))
    none = F.array().cast(spans)
    df = df.withColumns({c: F.when(F.col(t).isNotNull(), p).otherwise(none) for c, t, p in zip(cut, steps, positions)})
    ordered = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    df = df.withColumn(name, F.array_sort(F.transform(F.concat(*map(F.col, cut)), ordered)))
    return df.select(*docs.columns, name)


def spans_text(spans: Column, rules: tuple[SecretRule, ...]) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    one = lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def _merged(spans: Column) -> Column:
    """Sorted spans (start, end) with those that overlap joined, in blocks of a list with at least one."""
    kind = "array<struct<start:int,end:int>>"
    pair = lambda a, b: F.struct(a.alias("start"), b.alias("end"))

    def add(acc, s):
        last = acc["last"]
        grown = F.struct(pair(last["start"], F.greatest(last["end"], s["end"])).alias("last"), acc["out"].alias("out"))
        closed = F.struct(pair(s["start"], s["end"]).alias("last"), F.concat(acc["out"], F.array(last)).alias("out"))
        return F.when(s["start"] < last["end"], grown).otherwise(closed)

    def of_block(acc, block):
        inner = F.aggregate(block, F.struct(acc["last"].alias("last"), F.array().cast(kind).alias("out")), add)
        return F.struct(inner["last"].alias("last"), F.concat(acc["out"], F.array(inner["out"])).alias("out"))

    first = F.get(spans, F.lit(0))
    start = F.struct(pair(first["start"], first["end"]).alias("last"), F.array().cast(f"array<{kind}>").alias("out"))
    whole = lambda acc: F.concat(F.flatten(acc["out"]), F.array(acc["last"]))
    return F.aggregate(in_blocks(F.slice(spans, F.lit(2), F.size(spans))), start, of_block, whole)


def _cut_out(text: Column, spans: Column, mark: str) -> Column:
    """The text with ``mark`` for each of its disjoint spans. A block's text is cut out first, then its spans."""
    end_of = lambda block: F.get(block, F.size(block) - 1)["end"]

    def of_blocks(blocks: Column) -> Column:
        def of_block(block: Column, k: Column) -> Column:
            # From the end of the block before to its own last span's end.
            lo = F.when(k == 0, 0).otherwise(end_of(F.get(blocks, k - 1)))

            def pieces(x: Column) -> Column:
                before = lambda i: F.when(i == 0, x["lo"]).otherwise(F.get(block, i - 1)["end"])
                kept = F.transform(block, lambda s, i: F.substring(x["text"], before(i) - x["lo"] + 1, s["start"] - before(i)))
                return F.concat(F.array_join(kept, mark), F.lit(mark))

            return _let(F.struct(lo.alias("lo"), F.substring(text, lo + 1, end_of(block) - lo).alias("text")), pieces)

        rest = end_of(F.get(blocks, F.size(blocks) - 1))
        return F.concat(F.array_join(F.transform(blocks, of_block), ""), F.substring(text, rest + 1, F.length(text)))

    return _let(in_blocks(spans), of_blocks)


def redact(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """The table with every span of a text replaced by ``mark`` (spans that overlap: by one mark)."""
    spans, whole = free_names(docs.columns, ["secret_spans", "secret_merged"])
    found = find_secrets(docs, rules, spans)
    merged = found.withColumn(whole, F.when(F.size(spans) > 0, _merged(F.col(spans))))
    clean = F.when(F.col(whole).isNotNull(), _cut_out(F.col("text"), F.col(whole), mark)).otherwise(F.col("text"))
    return merged.withColumn("text", clean).select(*docs.columns)
