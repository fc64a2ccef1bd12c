"""Main text of web pages by equivalence-class template deduction.

A page is a sequence of tokens: start and end tags told apart by their path, and text blocks
told apart by their path and text. Over the pages of a host:

1. Tokens with the same occurrence vector (how often they occur on each page) form an
   equivalence class. A vector is kept as the number of its pages and the exclusive or of
   hashes of (page, count), so it is summed like a count: in each task, then by (host,
   token). No host's pages have to meet, and a host with a third of all pages is as cheap
   as others.
2. Large and frequent classes (``MIN_SIZE`` tokens, ``MIN_PAGES`` pages and ``MIN_SHARE`` of
   the host's pages) are valid when on every page their tokens come in one order and each
   class lies within one gap between the tokens of the classes taken before it. Valid
   classes, nested, are the host's template; its tags are the frame, its text blocks are
   what every page repeats.
3. What lies between the template's tokens are slots. Slots in elements that hold no article
   (menus, headers, footers, sidebars, notices, adverts, forms, scripts, comments: by
   element, role, class or id) are left out. The rest is the article: the text in article
   elements; without one, in the main element; else in an element that is named as the
   content (all the outermost ones with a slot); else all other slots, where the template's own text blocks are dropped too.

Inside a page's article or main element nothing is dropped for being repeated: pages of a
host may share paragraphs, or be copies.

Cases: a null or empty page has an empty text; a null URL or one without ``://`` belongs to
the host named by the empty string; hosts with few pages have no template and rule 3 alone
decides; repeated rows are extracted alike; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructType

from affinity.llm.common import ascii_lower, lists, slices
from affinity.llm.html_parse import Page, read_page
from affinity.session import write_stage

MIN_PAGES = 3
MIN_SHARE = 0.5
MIN_SIZE = 2
#: Entries of a task's table of tokens before it is handed on and begun anew.
TABLE_ENTRIES = 300_000


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _tokens(batches: Iterator[pa.RecordBatch], schema: pa.Schema):
    for batch in slices(batches):
        tokens = [np.array(read_page(h or "").tokens, dtype=np.uint64).view(np.int64) for h in batch.column("html").to_pylist()]
        flat = np.concatenate([np.empty(0, dtype=np.int64), *tokens])
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), lists(flat, [len(t) for t in tokens], pa.int64())], schema=schema
        )


def _vectors(batches: Iterator[pa.RecordBatch], schema: pa.Schema):
    """(page, host, tokens) -> (host, token, pages, vector) summed over what the task has read."""
    table: dict[tuple[str, int], list[int]] = {}

    def rows():
        keys = list(table)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.int64()),
                pa.array([table[k][0] for k in keys], pa.int64()),
                pa.array([table[k][1] for k in keys], pa.int64()),
            ],
            schema=schema,
        )
        table.clear()

    for batch in slices(batches):
        for page, host, tokens in zip(*(batch.column(c).to_pylist() for c in ("page", "host", "tokens"))):
            found, counts = np.unique(np.array(tokens, dtype=np.int64), return_counts=True)
            for t, n in zip(found.tolist(), counts.tolist()):
                entry = table.setdefault((host, t), [0, 0])
                entry[0] += 1
                entry[1] ^= _signed(xxhash.xxh64_intdigest(b"%d:%d" % (page, n)))
        if len(table) > TABLE_ENTRIES:
            yield from rows()
    yield from rows()


def _conflicts(batches: Iterator[pa.RecordBatch], schema: pa.Schema):
    """(host, tokens, classes) -> (host, class, low, high, crossed): the range of order hashes, and whether it crosses."""
    seen: dict[tuple[str, int], list] = {}
    for batch in slices(batches):
        # Classes come ordered: those of most pages, then most tokens, first.
        for host, tokens, classes in zip(*(batch.column(c).to_pylist() for c in ("host", "tokens", "classes"))):
            if not classes:
                continue
            rank = {t: k for k, c in enumerate(classes) for t in c["members"]}
            places = defaultdict(list)
            order = defaultdict(list)
            for i, t in enumerate(tokens):
                if (k := rank.get(t)) is not None:
                    places[k].append(i)
                    order[k].append(t)
            taken: list[np.ndarray] = []
            for k in sorted(places):
                sign = _signed(xxhash.xxh64_intdigest(np.array(order[k], dtype=np.int64).tobytes()))
                first, last = places[k][0], places[k][-1]
                # A class that repeats on the page may fill gaps of the others; one that does not must lie in one gap.
                once = len(places[k]) == len(set(order[k]))
                crossed = False
                if once:
                    for p in taken:
                        a, b = np.searchsorted(p, (first, last))
                        around = first < p[0] and last > p[-1]
                        crossed |= bool(a != b) and not around
                    if not crossed:
                        taken.append(np.array(places[k]))
                entry = seen.setdefault((host, classes[k]["id"]), [sign, sign, False])
                entry[0], entry[1] = min(entry[0], sign), max(entry[1], sign)
                entry[2] |= crossed
    keys = list(seen)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in keys], pa.string()),
            pa.array([k[1] for k in keys], pa.int64()),
            *(pa.array([seen[k][i] for k in keys], pa.int64()) for i in (0, 1)),
            pa.array([seen[k][2] for k in keys], pa.bool_()),
        ],
        schema=schema,
    )


def host_of(url):
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return ascii_lower(host)


def deduce_templates(
    pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, min_size: int = MIN_SIZE
) -> DataFrame:
    """(host, template): the tokens of the host's valid equivalence classes."""
    schema = pa.schema([("host", pa.string()), ("tokens", pa.list_(pa.int64()))])
    read = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(
        lambda it: _tokens(it, schema), "host string, tokens array<long>"
    )
    # The written table fixes each page's number.
    read = write_stage(read.withColumn("page", F.monotonically_increasing_id()), "page_tokens")
    vector_schema = pa.schema([("host", pa.string()), *((c, pa.int64()) for c in ("token", "pages", "vector"))])
    parts = read.select("page", "host", "tokens").mapInArrow(
        lambda it: _vectors(it, vector_schema), "host string, token long, pages long, vector long"
    )
    vectors = parts.groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"))
    sizes = read.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    frequent = write_stage(vectors.where(F.col("pages") >= min_pages), "page_vectors")
    frequent = frequent.join(sizes, "host").where(F.col("pages") >= F.col("host_pages") * min_share)
    # A class has no more tokens than any one of its pages.
    classes = (
        frequent.groupBy("host", "pages", "vector")
        .agg(F.sort_array(F.collect_list("token")).alias("members"))
        .where(F.size("members") >= min_size)
        .select("host", F.xxhash64("pages", "vector").alias("id"), "pages", "members")
    )
    classes = write_stage(classes, "page_classes")
    ordered = classes.groupBy("host").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("pages", F.size("members").alias("n"), "id", "members")), asc=False),
            lambda c: F.struct(c["id"].alias("id"), c["members"].alias("members")),
        ).alias("classes")
    )
    ordered = write_stage(ordered, "page_class_lists")
    conflict_schema = pa.schema(
        [("host", pa.string()), ("id", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("crossed", pa.bool_())]
    )
    judged = read.select("host", "tokens").join(ordered, "host").mapInArrow(
        lambda it: _conflicts(it, conflict_schema), "host string, id long, low long, high long, crossed boolean"
    )
    valid = (
        judged.groupBy("host", "id")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("crossed").alias("crossed"))
        .where("low = high AND NOT crossed")
        .select("host", "id")
    )
    kept = classes.join(valid, ["host", "id"]).groupBy("host")
    return write_stage(kept.agg(F.flatten(F.collect_list("members")).alias("template")), "page_templates")


def main_text(page: Page, template: frozenset[int]) -> str:
    """The article's blocks, joined by an empty line."""
    inside = [b for b in page.blocks if not b[3]]

    def under(kind: str) -> list[str]:
        chosen = set()
        for i, (k, token, above, outside) in enumerate(page.regions):
            if not outside and (k == kind or above in chosen):
                chosen.add(i)
        return [text for text, region, _, _ in inside if region in chosen]

    for kind in ("article", "main"):
        if texts := under(kind):
            return "\n\n".join(texts)
    slots = [b for b in inside if _token(b[2]) not in template]
    named = {i for i, r in enumerate(page.regions) if r[0] == "named" and not r[3]}
    if named:
        # The named elements that stand in no other named one and hold more than the template.
        outer = {}
        for i in sorted(named):
            above = page.regions[i][2]
            outer[i] = outer.get(above, above) if above in named else i
        if chosen := {outer[region] for _, region, _, _ in slots if region in outer}:
            return "\n\n".join(text for text, region, _, _ in inside if outer.get(region) in chosen)
    return "\n\n".join(text for text, _, _, _ in slots)


def _token(x: int) -> int:
    return _signed(x)


def _extract(batches: Iterator[pa.RecordBatch], schema: pa.Schema):
    for batch in slices(batches):
        known: dict[str, frozenset[int]] = {}
        texts = []
        for html, host, template in zip(*(batch.column(c).to_pylist() for c in ("html", "host", "template"))):
            if host not in known:
                known[host] = frozenset(template or ())
            texts.append(main_text(read_page(html or ""), known[host]))
        keep = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] not in ("html", "host", "template")]
        n = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([*keep, pa.array(texts, pa.string()), n], schema=schema)


def extract_main_text(pages: DataFrame, **thresholds) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    templates = deduce_templates(pages, **thresholds)
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html").join(templates, "host", "left")
    out = StructType([*rows.select("page_id", "url").schema.fields]).add("text", StringType()).add("n_chars", LongType())
    schema = to_arrow_schema(out)
    return rows.select("page_id", "url", "host", "html", "template").mapInArrow(lambda it: _extract(it, schema), out)
