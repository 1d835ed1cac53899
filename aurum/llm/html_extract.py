"""Main text of pages by equivalence-class template deduction.

The tokens of a page are its elements, by the path of elements around them, and its blocks of text, by path and text,
in page order.  Pages of a host with an equal sequence of blocks are copies and count as one.  For each host, tokens
that occur equally often in each page (equal occurrence vectors over all of the host's distinct pages) form an
equivalence class, if they are several and occur in enough of the host's distinct pages.

Nesting: the classes of a host are ranked, those of more pages and then of more tokens first.  On every page a class
is open from its first token to its last, and a token has a place: its number in its class, the innermost open class
of a higher rank around it, and the slot of that class, named by the token of it that came last.  A token stays in
its class if all but a tenth of its occurrences (``MIN_KEPT``) have one place, a class is valid if several tokens
stay.  So the tokens of a valid class keep one order, and lie in the same slot or slots of the class around it; a class
that reaches over several slots is divided by them.  These parts, each in its slot, are the template (``templates``);
a few pages with blocks in another order do not void it.

What fills the slots of the template is the pages' own text (``slots``).  Slots inside elements that hold no article
(see ``html_blocks``) are left out.  If a page marks its article (``article``, ``main`` and the like) its slots are
taken; else every slot that holds own text, whatever its path: nothing else is dropped.

An article that several pages share is no template: not a class that only some of the distinct pages have and that
holds more text than all that those pages have of their own.  Text in a marked article is template only if every
distinct page with a marked article has it, equally often, and if the class holds less of it than those pages have of
their own (a line to share the page, say).

Scale: the distinct pages are a slim table of token hashes, one row for each host and content; copies combine before
the shuffle.  An occurrence vector is summed up by the exclusive-or of a hash of (content, number) over the distinct
pages that have the token, and places are counted, both in the tasks and before the shuffle, so a host that a third of
all pages share is no large group.  Of a host's tokens only those in half of its pages go on, which a page's length
bounds.  The pages are read twice and never shuffled while the hosts' templates can be broadcast (by their counted
tokens); else they meet their host's template in a join that adaptive execution can split.

Defined results: null html is empty and gives an empty text.  Pages without a host (null or odd urls) are one host of
their own.  Hosts with fewer than ``MIN_PAGES`` distinct pages have no template.  Repeated rows each get a row.  An empty table
gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import BROADCAST_ROWS, bounded, staged
from aurum.llm.html_blocks import Page, read

MIN_PAGES = 5
MIN_SHARE = 0.5
MIN_TOKENS = 3
MIN_KEPT = 0.9
#: Entries of one task's table of tokens before it is handed on.
ENTRIES = 100_000
#: Hosts whose classes a task remembers.
HOSTS = 256
#: Kinds of tokens: elements, blocks of text, blocks of text in a marked article.
ELEMENT, TEXT, INSIDE = 0, 1, 2

_CONTENT = "host string, content long, tokens array<long>, sizes array<int>"
_TOKENS = "host string, token long, vector long, pages long, kind int"
_PLACES = "host string, class int, token long, at int, parent int, slot int, n long, chars long, inside long"
_SLOTS = "array<struct<part: int, slot: int, text: string>>"


def _host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def _hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text)
    return value - (1 << 64) if value >> 63 else value


@lru_cache(maxsize=1 << 16)
def _element_token(path: str) -> int:
    return _hash(path)


def _text_token(path: str, text: str) -> int:
    return _hash(f"{path}\0{text}")


def page_tokens(page: Page) -> tuple[int, list[int], list[int]]:
    """``content, tokens, sizes`` of a page, the tokens in page order.

    The content is a hash of its blocks' texts.  An element has size 0, a block its characters, which are negative in
    a marked article.
    """
    tokens, sizes, done = [], [], 0
    for path, text, region, at in page.blocks:
        tokens += map(_element_token, page.elements[done:at])
        tokens.append(_text_token(path, text))
        sizes += [0] * (at - done)
        sizes.append(-len(text) if region and page.has_region else len(text))
        done = at
    tokens += map(_element_token, page.elements[done:])
    sizes += [0] * (len(page.elements) - done)
    return _hash("\0".join(b[1] for b in page.blocks)), tokens, sizes


def contents(pages: DataFrame) -> DataFrame:
    """One row for each host and content (equal sequence of blocks of text), however many pages have it."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = zip(*[page_tokens(read(text.as_py())) for text in batch.column(1)], strict=True)
            content, names, sizes = columns if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(content, pa.int64()),
                 pa.array(names, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32()))],
                names=["host", "content", "tokens", "sizes"])

    rows = pages.select(_host(F.col("url")).alias("host"), "html").mapInArrow(parsed, _CONTENT)
    return rows.groupBy("host", "content").agg(F.min(F.struct("tokens", "sizes")).alias("page")) \
        .select("host", "content", "page.*")


def _kind(size: int) -> int:
    return INSIDE if size < 0 else TEXT if size else ELEMENT


def tokens(found: DataFrame) -> DataFrame:
    """``host, token, vector, pages, kind`` over all contents of a host."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[tuple[str, int], list] = {}

        def handed_on() -> pa.RecordBatch:
            hosts, names = zip(*table, strict=True)
            vectors, n_pages, kinds = zip(*table.values(), strict=True)
            table.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(hosts), pa.array(names, pa.int64()),
                 pa.array([v - (1 << 64) if v >> 63 else v for v in vectors], pa.int64()),
                 pa.array(n_pages, pa.int64()), pa.array(kinds, pa.int32())],
                names=["host", "token", "vector", "pages", "kind"])

        for batch in batches:
            for row in batch.to_pylist():
                kinds = dict(zip(row["tokens"], map(_kind, row["sizes"]), strict=True))
                for token, n in Counter(row["tokens"]).items():
                    seen = table.setdefault((row["host"], token), [0, 0, 0])
                    seen[0] ^= xxhash.xxh64_intdigest(f"{row['content']}:{n}")
                    seen[1] += 1
                    seen[2] = max(seen[2], kinds[token])
                if len(table) >= ENTRIES:
                    yield handed_on()
        if table:
            yield handed_on()

    return found.select("host", "content", "tokens", "sizes").mapInArrow(count, _TOKENS).groupBy("host", "token").agg(
        F.expr("bit_xor(vector)").alias("vector"), F.sum("pages").alias("pages"), F.max("kind").alias("kind"))


class Classes:
    """A host's classes (or the parts of its template) by rank, each with its tokens."""

    def __init__(self, classes: list[list[int]]) -> None:
        self.lengths = [len(c) for c in classes]
        self.of = {token: i for i, c in enumerate(classes) for token in c}

    def places(self, page: list[int]) -> Iterator[tuple[int, int, int, int]]:
        """For each token of a page: its class (-1 for none), its number there, the class around it and the slot."""
        of = self.of
        left, seen = Counter(of[t] for t in page if t in of), [0] * len(self.lengths)
        begun: list[int] = []  # classes with tokens before and after, the innermost last
        for token in page:
            mine = of.get(token, -1)
            around = next((c for c in reversed(begun) if mine < 0 or c < mine), -1)
            slot = (seen[around] - 1) % self.lengths[around] if around >= 0 else -1
            if mine < 0:
                yield -1, -1, around, slot
                continue
            yield mine, seen[mine] % self.lengths[mine], around, slot
            if not seen[mine]:
                begun.append(mine)
            seen[mine] += 1
            left[mine] -= 1
            if not left[mine]:
                begun.remove(mine)


class _ByHost:
    """The classes of the hosts that a task met last."""

    def __init__(self) -> None:
        self.known: dict[str, Classes] = {}

    def get(self, host: str, classes: pa.Scalar) -> Classes:
        if (mine := self.known.get(host)) is None:
            if len(self.known) >= HOSTS:
                self.known.clear()
            mine = self.known[host] = Classes(classes.as_py() or [])
        return mine


def _for_hosts(classes: DataFrame) -> DataFrame:
    """``classes`` (``host, classes``), broadcast if all of their tokens are few."""
    held = classes.agg(F.sum(F.size(F.flatten("classes")) + 1)).first()[0] or 0
    return F.broadcast(classes) if held <= BROADCAST_ROWS else classes


def _places(found: DataFrame, known: DataFrame) -> DataFrame:
    """How often (``n``) each token has each place, with its characters outside of and inside marked articles.

    A row without a token has the pages with the class (``n``) and their text that no class has (``chars``).
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[tuple, list[int]] = {}
        by_host = _ByHost()

        def handed_on() -> pa.RecordBatch:
            keys, sums = list(zip(*table, strict=True)), list(zip(*table.values(), strict=True))
            table.clear()
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), *[pa.int64()] * 3]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(keys + sums, kinds, strict=True)],
                                              names=["host", "class", "token", "at", "parent", "slot", "n", "chars", "inside"])

        for batch in batches:
            hosts, classes = batch.column(0), batch.column(3)
            for i, (page, sizes) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                host, rest, mine = hosts[i].as_py(), 0, set()
                for token, size, (at_class, at, parent, slot) in zip(
                        page, sizes, by_host.get(host, classes[i]).places(page), strict=True):
                    if at_class < 0:
                        rest += abs(size)
                        continue
                    mine.add(at_class)
                    seen = table.setdefault((host, at_class, token, at, parent, slot), [0, 0, 0])
                    seen[0] += 1
                    seen[1 if size > 0 else 2] += abs(size)
                for at_class in mine:
                    seen = table.setdefault((host, at_class, None, None, None, None), [0, 0, 0])
                    seen[0] += 1
                    seen[1] += rest
                if len(table) >= ENTRIES:
                    yield handed_on()
        if table:
            yield handed_on()

    rows = found.join(_for_hosts(known), "host").select("host", "tokens", "sizes", "classes")
    return rows.mapInArrow(count, _PLACES).groupBy("host", "class", "token", "at", "parent", "slot").agg(
        *[F.sum(c).alias(c) for c in ("n", "chars", "inside")])


def templates(pages: DataFrame) -> DataFrame:
    """The nested template: ``host, class, parent, slot, tokens, inside``, one row for each part of a valid class.

    ``class`` is its rank; ``parent`` and ``slot`` are the class around it and the number of the token of that class
    before it (-1 outside all classes); ``tokens`` are in page order, ``inside`` tells of text of a marked article.
    """
    found = staged(contents(pages), "html_contents")
    marked = F.exists("sizes", lambda size: size < 0).cast("long")
    hosts = staged(found.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"), F.sum(marked).alias("n_marked"))
                   .where(F.col("n_pages") >= MIN_PAGES), "html_hosts")
    everywhere = (F.col("pages") == F.col("n_marked")) & (F.col("n_marked") >= MIN_PAGES)
    frequent = tokens(found).join(bounded(hosts), "host").where(
        (F.col("pages") >= MIN_SHARE * F.col("n_pages")) & ((F.col("kind") < INSIDE) | everywhere))
    classes = frequent.groupBy("host", "vector", "pages").agg(
        F.count(F.lit(1)).alias("n_tokens"), F.sort_array(F.collect_list("token")).alias("tokens")) \
        .where(F.col("n_tokens") >= MIN_TOKENS)
    ranked = F.sort_array(F.collect_list(F.struct(-F.col("pages"), -F.col("n_tokens"), "vector", "tokens")))
    known = staged(classes.groupBy("host").agg(ranked.alias("c")).select("host", F.col("c.tokens").alias("classes")),
                   "html_classes")
    places = staged(_places(found, known), "html_places")

    by_token = places.where(F.col("token").isNotNull()).groupBy("host", "class", "token").agg(
        F.max(F.struct("n", "at", "parent", "slot")).alias("most"),
        *[F.sum(c).alias(c) for c in ("n", "chars", "inside")]).withColumn("stays", F.col("most.n") >= MIN_KEPT * F.col("n"))
    own = places.where(F.col("token").isNull()).select("host", "class", F.col("n").alias("pages"), F.col("chars").alias("rest"))
    by_class = by_token.groupBy("host", "class").agg(
        F.sum("chars").alias("all_chars"), F.sum("inside").alias("all_inside"),
        F.count(F.when(F.col("stays"), 1)).alias("n_stay")) \
        .join(own, ["host", "class"]).join(bounded(hosts), "host")
    # a class that only some contents have, with more text than all they have of their own, is an article of theirs
    article = (F.col("pages") < F.col("n_pages")) & (F.col("all_chars") > F.col("rest"))
    valid = by_class.where((F.col("n_stay") >= MIN_TOKENS) & ~article).select(
        "host", "class", (F.col("all_inside") > F.col("rest")).alias("shared"))
    parts = by_token.where("stays").join(valid, ["host", "class"]).where(~(F.col("shared") & (F.col("inside") > 0))) \
        .groupBy("host", "class", "most.parent", "most.slot").agg(
            F.sort_array(F.collect_list(F.struct("most.at", "token"))).alias("t"),
            F.max(F.col("inside") > 0).alias("inside")) \
        .select("host", "class", "parent", "slot", F.col("t.token").alias("tokens"), "inside")
    return staged(parts, "html_templates")


def slots(page: Page, template: Classes | None) -> list[tuple[int, int, str]]:
    """``part, slot, text`` of the page's own text in its main slots, in page order."""
    if not template:
        return [(-1, -1, text) for _, text, region, _ in page.blocks if region or not page.has_region]
    _, names, sizes = page_tokens(page)
    texts, out = iter(page.blocks), []
    for size, (part, _, around, slot) in zip(sizes, template.places(names), strict=True):
        if size:
            text = next(texts)[1]
            if part < 0 and (size < 0 or not page.has_region):
                out.append((around, slot, text))
    return out


def main_text(page: Page, template: Classes | None) -> str:
    """The page's own text in its main slots, blocks joined by a line feed."""
    return "\n".join(text for _, _, text in slots(page, template))


def extract(pages: DataFrame, with_slots: bool = False) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``; if asked for, its ``slots`` (part, slot and text) as well.

    Parts are numbered by class and slot, as the host's rows of ``templates`` are in order of ``class, parent, slot``.
    """
    ranked = F.sort_array(F.collect_list(F.struct("class", "parent", "slot", "tokens")))
    by_host = staged(templates(pages).groupBy("host").agg(ranked.alias("c")).select(
        "host", F.col("c.tokens").alias("classes")), "html_host_templates")
    kind = pages.schema["page_id"].dataType.simpleString()

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_host = _ByHost()
        for batch in batches:
            found = [slots(read(source.as_py()), by_host.get(host.as_py(), classes) if classes.is_valid else None)
                     for source, host, classes in zip(batch.column(2), batch.column(3), batch.column(4), strict=True)]
            texts = ["\n".join(s[2] for s in of) for of in found]
            arrays = [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                      pa.array([len(t) for t in texts], pa.int64())]
            names = ["page_id", "url", "text", "n_chars"]
            if with_slots:
                fields = pa.struct([("part", pa.int32()), ("slot", pa.int32()), ("text", pa.string())])
                arrays.append(pa.array([[dict(zip(("part", "slot", "text"), s, strict=True)) for s in of] for of in found],
                                       pa.list_(fields)))
                names.append("slots")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"page_id {kind}, url string, text string, n_chars long" + (f", slots {_SLOTS}" if with_slots else "")
    return pages.select("page_id", "url", "html", _host(F.col("url")).alias("host")) \
        .join(_for_hosts(by_host), "host", "left").select("page_id", "url", "html", "host", "classes") \
        .mapInArrow(extracted, schema)
