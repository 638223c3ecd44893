"""Similarity join on word n-grams by Jaccard (operator 9).

A document is its set of distinct word shingles (64-bit hashes; two sets are
taken for one if their 64-bit digests agree).  Shingle length and threshold are
a ``Rule``: the query's is three words and 0.9, a caller may give its own, and
size bands, parts and the overlap that links follow from it.  Equal sets are
one class, and classes are joined:

1. Tiles.  Sets are put in bands by size, a set near a band's upper edge also
   in the next one.  Two sets of a band that reach the threshold differ in at
   most ``d`` shingles, ``d`` following from the band's largest size.  A band
   deals shingles by hash into more than ``d`` parts, so such sets have a part
   in common that is exactly the same; a tile is (band, part, content).  Parts
   that are empty count only for sets with more empty parts than there are
   parts to spare.  No pair above the threshold can be missed.
2. Classes that tiles connect form a group.  A group of more than a block is
   first thinned: each tile's classes are compared with the tile's least one.
   Then the classes that are still in different components of their group are
   compared with each other, in pairs of blocks of bounded size.
3. A comparison first bounds the overlap from hashed bitmaps: a bit of one and
   not of the other is a shingle of one and not of the other.  What passes is
   decided by intersecting the sorted arrays.

Below ``THIN`` the parts would hold so few shingles that most of a corpus would
share tiles, so there a tile is (band, single shingle).  Of the shingles below a fixed
hash, a set with more than ``1 - threshold`` of its size found in no other set
links with nothing.  The sets left are ordered with shingles found in one set
first, then by hash: linked sets share a shingle among the first
``n - ceil(threshold * n) + 1``, and those found in one set make no tile.  What connects
classes there is not one tile but as many as a link needs (``rare_pairs``): single tiles
would make most of a large corpus one group.

A batch sends one row per tile to the shuffle, however many of its classes
share the tile (these are tied to it by a tile of the batch's own), so a group
of near copies never arrives in one task.

Defined results: a text without words has no shingles, links with nothing and
is its own component, as is a row without an id that links with no row that
has one (component null); repeated rows link; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, chunks, cut, may_match, table, text_or_empty, with_match, without
from .wordhash import distinct, mix, ngrams, split_words, word_hashes


class Rule(NamedTuple):
    """Words of a shingle, and the threshold as a fraction: linked when
    den * intersection >= num * union."""

    shingle: int
    num: int
    den: int


#: The rule of the query.
QUERY_RULE = Rule(3, 9, 10)
#: Thresholds below this fraction use single shingles as tiles.
THIN = (9, 10)
#: Share of the shingles, by hash, that the first test of a set looks at.
LOOKED_AT = 0.35
#: Leading bits of a shingle that this test tells shingles apart by: what agrees in them
#: counts as shared, which leaves a set in.  The others are zero, and move as nothing.
LOOKED_BITS = 40
BAND_RATIO = 1.5
BITMAP_BITS = 4096
BLOCK = 512
#: Classes of a single-shingle tile up to which its pairs are counted one by one.
CROWD = 64

_U = np.uint64
_EDGES = [1]
while _EDGES[-1] < 1 << 40:
    _EDGES.append(max(_EDGES[-1] + 1, int(_EDGES[-1] * BAND_RATIO)))
_EDGES = np.array(_EDGES, np.int64)


def _parts(band: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """(parts, parts to spare) of the bands."""
    top = _EDGES[band + 1] - 1
    d = 2 * top * (rule.den - rule.num) // (rule.den + rule.num)
    spare = np.minimum(d, 2)
    return d + 1 + spare, spare


def _sets(texts: pa.Array, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle) pairs ascending, and size and digest of every text's set."""
    b = split_words(texts, lower=True)
    doc, h = distinct(*ngrams(b, word_hashes(b), rule.shingle, short=True))
    n = np.bincount(doc, minlength=b.n_docs)
    digest = np.zeros(b.n_docs, _U)
    np.add.at(digest, doc, mix(h, 7))
    return doc, h, n, mix(digest + n.astype(_U), 5).view(np.int64)


def set_classes(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, text_hash, n_shingles and class (null without shingles) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            _, _, n, digest = _sets(batch.column(2), rule)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n.astype(np.int64)), pa.array(digest, mask=n == 0)], ["doc_id", "text_hash", "n_shingles", "class"])

    src = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_hash"), text_or_empty().alias("text"))
    return arrow_map(src, run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text_hash long, n_shingles long, class long")


def signatures(doc: np.ndarray, h: np.ndarray, n: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """(text, tile) of every tile that the sets belong to."""
    texts, tiles = [], []
    own = np.searchsorted(_EDGES, np.maximum(n, 1), "right") - 1
    for up in (0, 1):
        band = own + up
        use = (n > 0) if up == 0 else (n > 0) & (n * rule.den >= rule.num * _EDGES[own + 1])
        parts, spare = _parts(band, rule)
        first = np.concatenate([[0], np.cumsum(np.where(use, parts, 0))])
        mine = use[doc]
        d, g = doc[mine], h[mine]
        at = first[d] + (mix(g, 11) % parts[d].astype(_U)).astype(np.int64)
        content, size = np.zeros(first[-1], _U), np.zeros(first[-1], np.int32)
        np.add.at(content, at, mix(g, 13))
        np.add.at(size, at, 1)
        text = np.repeat(np.arange(len(n)), np.diff(first))
        part = np.arange(first[-1]) - first[text]
        empty = np.bincount(text[size == 0], minlength=len(n))
        keep = (size > 0) | (empty[text] > spare[text])
        tile = mix(content + mix((part + (band[text] << 32)).astype(_U), 17), 19)
        texts.append(text[keep])
        tiles.append(tile[keep].view(np.int64))
    return np.concatenate(texts), np.concatenate(tiles)


def tile_members(docs: DataFrame, rule: Rule) -> DataFrame:
    """tile, class: a class is in a tile.  If several classes of a batch share
    one, the least stands for them there and is tied to the others in a tile of
    the batch's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            doc, h, n, digest = _sets(batch.column(0), rule)
            text, tile = signatures(doc, h, n, rule)
            cls = digest[text]
            order = np.lexsort((cls, tile))
            tile, cls = tile[order], cls[order]
            new = np.ones(len(tile), bool)
            new[1:] = (tile[1:] != tile[:-1]) | (cls[1:] != cls[:-1])
            tile, cls = tile[new], cls[new]
            head = np.ones(len(tile), bool)
            head[1:] = tile[1:] != tile[:-1]
            least = cls[np.flatnonzero(head)][np.cumsum(head) - 1] if len(cls) else cls
            tied = ~head
            lead = np.zeros(len(tile), bool)  # heads with others
            lead[:-1] = head[:-1] & ~head[1:]
            sub = mix(tile.view(_U) + mix(least.view(_U), 23), 29).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([tile[head], sub[tied], sub[lead]])),
                    pa.array(np.concatenate([cls[head], cls[tied], cls[lead]])),
                ],
                ["tile", "class"],
            )

    return arrow_map(docs.select(text_or_empty().alias("text")), run, "tile long, class long")


def shingle_rows(docs: DataFrame, rule: Rule, share: float = 1.0) -> DataFrame:
    """shingle, class of every set; with ``share``, only the shingles of least hash."""
    top = _U(min(int(share * 2**64), 2**64 - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            doc, h, _, digest = _sets(batch.column(0), rule)
            low = h <= top
            yield pa.RecordBatch.from_arrays([pa.array(h[low].view(np.int64)), pa.array(digest[doc[low]])], ["shingle", "class"])

    return arrow_map(docs.select(text_or_empty().alias("text")), run, "shingle long, class long")


def _row_key(doc_id: str, text_hash: str) -> Column:
    return F.xxhash64(doc_id, text_hash)


def _with_texts(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """``reps`` (class, __id, __hash and others) with the text of a row of that id and hash."""
    src = docs.select("doc_id", text_or_empty().alias("text")).withColumn("text_hash", F.xxhash64("text"))
    # of the other texts only those that pass a filter on id and hash are moved
    src = may_match(src, _row_key("doc_id", "text_hash"), reps.select(_row_key("__id", "__hash").alias("key")))
    # the candidates follow the corpus, so no size of theirs makes a broadcast safe
    found = src.join(reps.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash")))
    return found.dropDuplicates(["class"])


def may_link(docs: DataFrame, classes: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """One row of ``docs`` and of ``classes`` for every class that may link with another one."""
    looked = shingle_rows(docs, rule, LOOKED_AT).withColumn("shingle", F.col("shingle").bitwiseAND(F.lit(-1 << (64 - LOOKED_BITS))))
    seen = looked.groupBy("shingle").agg(F.min("class").alias("lo"), F.max("class").alias("hi"))
    alone = seen.where("lo = hi").groupBy(F.col("lo").alias("__class")).agg(F.count(F.lit(1)).alias("alone"))
    sets = classes.where("`class` IS NOT NULL").groupBy("class", "n_shingles").agg(F.min(F.struct("doc_id", "text_hash")).alias("r"))
    left = sets.join(alone, F.col("class") == F.col("__class"), "left")
    left = left.where(F.coalesce("alone", F.lit(0)) * rule.den <= F.col("n_shingles") * (rule.den - rule.num))
    left = cut(left.select("class", "n_shingles", F.col("r.doc_id").alias("__id"), F.col("r.text_hash").alias("__hash")), "may-link-ids")
    left = cut(_with_texts(docs, left).select("doc_id", "text", "text_hash", "class", "n_shingles"), "may-link")
    return left.select("doc_id", "text"), left.select("doc_id", "text_hash", "n_shingles", "class")


def _bands(n: Column, rule: Rule) -> Column:
    """The size bands of a set: its own, and the next one if it is near its upper
    edge, so that sets which may link by their sizes have a band in common."""
    edges = F.array(*[F.lit(int(e)) for e in _EDGES])
    own = F.size(F.filter(edges, lambda e: e <= n))  # places from 1: the edge at this place is the band's lower one
    near = n * rule.den >= F.element_at(edges, own + 1) * rule.num
    return F.when(near, F.array(own, own + 1)).otherwise(F.array(own))


def rare_pairs(docs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a < b) of classes that may link, and ``crowded``: whether only a tile of more
    than ``CROWD`` classes says so; one row of ``docs`` and ``classes`` per class.

    In other tiles every pair is counted.  Of two linked sets, take the one whose first
    shingles end first: all that they share up to there are shared tiles, and beyond are
    ``ceil(threshold * n) - 1`` of its shingles, so they need that many shared tiles less.
    A crowded tile ties its classes to its least one instead, as do parts of sets."""
    rows = shingle_rows(docs, rule)  # of the sets left only: made again, not written
    seen = rows.groupBy(F.col("shingle").alias("__s")).agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo < hi").select("__s")
    both = rows.join(seen, F.col("shingle") == F.col("__s")).select("shingle", F.col("class").alias("__class"))
    sizes = classes.select("class", "n_shingles", F.ceil(F.col("n_shingles") * rule.num / F.lit(rule.den)).alias("need"))
    of = Window.partitionBy("class")
    ranked = both.join(sizes, F.col("__class") == F.col("class")).select(
        "shingle", "class", "n_shingles", "need", F.count(F.lit(1)).over(of).alias("found"), F.row_number().over(of.orderBy("shingle")).alias("nth")
    )
    bands = _bands(F.col("n_shingles"), rule)
    tiles = ranked.where("nth <= found - need + 1").select("shingle", "class", "n_shingles", bands[0].alias("own"), F.explode(bands).alias("band"))
    tiles = cut(tiles, "tiles")
    ends = tiles.groupBy(F.col("shingle").alias("__s"), F.col("band").alias("__b")).agg(F.min("class").alias("least"), F.max("class").alias("most"), F.count(F.lit(1)).alias("k"))
    shared = tiles.join(ends.where("least < most"), (F.col("shingle") == F.col("__s")) & (F.col("band") == F.col("__b")))
    shared = cut(shared.select("shingle", "band", "class", "n_shingles", "own", "least", "k"), "shared")
    crowds = shared.where((F.col("k") > CROWD) & (F.col("class") != F.col("least"))).select(F.col("least").alias("a"), F.col("class").alias("b")).distinct()
    x, y = (shared.where(F.col("k") <= CROWD).select("shingle", "band", *[F.col(c).alias(f"{c}_{side}") for c in ("class", "n_shingles", "own")]) for side in "ab")
    # a pair counts in the lowest band that both are in
    met = x.join(y, ["shingle", "band"]).where("class_a < class_b AND band = greatest(own_a, own_b)")
    per = met.groupBy(F.col("class_a").alias("a"), F.col("class_b").alias("b"), "n_shingles_a", "n_shingles_b").agg(F.count(F.lit(1)).alias("met"))
    less, more = F.least("n_shingles_a", "n_shingles_b"), F.greatest("n_shingles_a", "n_shingles_b")
    needed = F.ceil((less + more) * rule.num / F.lit(rule.num + rule.den)) - F.ceil(more * rule.num / F.lit(rule.den)) + 1
    counted = per.where((less * rule.den >= more * rule.num) & (F.col("met") >= needed)).select("a", "b")
    flagged = counted.withColumn("crowded", F.lit(False)).unionByName(crowds.withColumn("crowded", F.lit(True)))
    return flagged.groupBy("a", "b").agg(F.max("crowded").alias("crowded"))


def _need(n_a: np.ndarray, n_b: np.ndarray, rule: Rule) -> np.ndarray:
    """Least intersection of linked sets of these sizes."""
    return -((-rule.num * (n_a + n_b)) // (rule.num + rule.den))


def _may_link(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, rule: Rule) -> np.ndarray:
    """Whether the bitmaps leave room for the overlap that a link needs."""
    only_a = np.bitwise_count(a & ~b).sum(axis=-1, dtype=np.int64)
    only_b = np.bitwise_count(b & ~a).sum(axis=-1, dtype=np.int64)
    return np.minimum(n_a - only_a, n_b - only_b) >= _need(n_a, n_b, rule)


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    both = np.sort(np.concatenate([a, b]), kind="stable")  # merges two sorted arrays
    return int((both[1:] == both[:-1]).sum())


def compare_group(side: np.ndarray, cls: np.ndarray, label: np.ndarray, texts: pa.Array, rule: Rule) -> list[tuple[int, int]]:
    """Links that join the components of a group's classes: across its two
    sides if it has two, else among all.  A pair that is already connected,
    by its labels or by links found here, is not compared."""
    doc, h, n, _ = _sets(texts, rule)
    words = BITMAP_BITS // 64
    bit = (mix(h, 37) % _U(BITMAP_BITS)).astype(np.int64)
    bits = np.zeros(len(n) * words, _U)
    np.bitwise_or.at(bits, doc * words + bit // 64, _U(1) << (bit % 64).astype(_U))
    bits = bits.reshape(len(n), words)
    first = np.concatenate([[0], np.cumsum(n)])
    order = np.argsort(n, kind="stable")
    side, cls, n, bits, begin = side[order], cls[order], n[order], bits[order], first[:-1][order]
    _, part = np.unique(label[order], return_inverse=True)  # component of each row, merged as links are found
    across = side.min() != side.max()
    links = []
    for i in range(len(n) - 1):
        stop = int(np.searchsorted(n, n[i] * rule.den // rule.num, "right"))
        j = np.arange(i + 1, stop)
        j = j[(part[j] != part[i]) & ((side[j] != side[i]) | (not across))]
        if not len(j):
            continue
        for k in j[_may_link(bits[i], n[i], bits[j], n[j], rule)]:
            if part[k] != part[i] and _overlap(h[begin[i] : begin[i] + n[i]], h[begin[k] : begin[k] + n[k]]) >= _need(n[i], n[k], rule):
                links.append((int(cls[i]), int(cls[k])))
                part[part == part[k]] = part[i]
    return links


def group_links(rows: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) found by ``compare_group`` in every group (g, lo, hi) of
    ``rows``, which also have side, class, label and text."""
    names = ["g", "lo", "hi", "side", "class", "label", "text"]
    sorted_rows = rows.select(*names).repartition("g", "lo", "hi").sortWithinPartitions("g", "lo", "hi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def out(group: pa.Table) -> pa.RecordBatch:
            side, cls, label = (group.column(c).to_numpy() for c in (3, 4, 5))
            links = compare_group(side, cls, label, group.column(6).combine_chunks(), rule)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            key = [t.column(c).to_numpy() for c in (0, 1, 2)]
            begin = 0
            for stop in np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in key])) + 1:
                yield out(t.slice(begin, int(stop) - begin))
                begin = int(stop)
            held = t.slice(begin)
        if held is not None and held.num_rows:
            yield out(held)

    return arrow_map(sorted_rows, run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """class, label: the least class of the component, for classes with edges.

    Every class hangs on its least neighbour, and by jumps from label to label on the
    root of that tree; then both ends of every edge become their roots, and edges
    within a tree, or doubled, go.  Only least classes among their neighbours are left,
    at most half of them, so edges are few after the first round."""
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    live = cut(edges.select(low, high).where("a < b").distinct(), "edges")
    total = live.select(F.col("a").alias("class"), F.col("b").alias("label"))
    first = True
    while not live.isEmpty():
        up = live.select(F.col("b").alias("class"), F.col("a").alias("label")).unionByName(live.select(F.col("a").alias("class"), F.col("a").alias("label")))
        roots, moved = cut(up.groupBy("class").agg(F.min("label").alias("label")), "labels"), True
        while moved:
            jump = roots.select(F.col("class").alias("__c"), F.col("label").alias("far"))
            step = cut(roots.join(jump, F.col("label") == F.col("__c")).select("class", F.col("label").alias("old"), F.col("far").alias("label")), "labels")
            roots, moved = step.select("class", "label"), not step.where("label <> old").isEmpty()
        at = roots.select(F.col("class").alias("__c"), F.col("label").alias("__root"))
        if first:
            total, first = roots, False
        else:
            total = cut(total.join(at, F.col("label") == F.col("__c"), "left").select("class", F.coalesce("__root", "label").alias("label")), "labels")
        half = live.join(at, F.col("a") == F.col("__c")).select(F.col("__root").alias("a"), "b")
        whole = half.join(at, F.col("b") == F.col("__c")).select("a", F.col("__root").alias("b"))
        live = cut(whole.select(low, high).where("a < b").distinct(), "edges")
    return total


def _blocks(members: DataFrame, block: int) -> DataFrame:
    """g, lo, hi, side of the block groups that compare all of a group's
    classes: each block with itself and with every other one."""
    nb = F.ceil(F.col("m") / F.lit(float(block))).cast("int")
    rows = members.withColumn("nb", nb).withColumn("block", F.pmod(F.xxhash64("class", F.lit(2)), F.col("nb")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    return rows.select("g", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("side"), "class", "label", "text")


def _stars(members: DataFrame, pairs: DataFrame, block: int) -> DataFrame:
    """Groups that compare a tile's classes with the tile's least one, in
    chunks of bounded size; the least one is in every chunk."""
    j = pairs.join(members.select("class", "text"), F.col("b") == F.col("class"))
    chunk = F.pmod(F.xxhash64("b", F.lit(3)), F.ceil(F.col("fans") / F.lit(float(block))).cast("int")).cast("int")
    fans = j.select(F.col("a").alias("g"), chunk.alias("lo"), F.lit(0).alias("hi"), F.lit(1).alias("side"), F.col("b").alias("class"), F.col("b").alias("label"), "text")
    heads = fans.select("g", "lo").distinct().join(members.select(F.col("class").alias("__c"), F.col("text").alias("t")), F.col("g") == F.col("__c"))
    return fans.unionByName(heads.select("g", "lo", F.lit(0).alias("hi"), F.lit(0).alias("side"), F.col("g").alias("class"), F.col("g").alias("label"), F.col("t").alias("text")))


def link_classes(docs: DataFrame, classes: DataFrame, block: int, rule: Rule) -> DataFrame:
    """class, label of every class that is linked with another one."""
    single = rule.num * THIN[1] < rule.den * THIN[0]
    if single:
        docs, classes = may_link(docs, classes, rule)
        pairs = cut(rare_pairs(docs, classes, rule), "pairs")
    else:
        in_tile = Window.partitionBy("tile")
        shared = tile_members(docs, rule).select("class", F.min("class").over(in_tile).alias("a"), F.max("class").over(in_tile).alias("most"))
        pairs = cut(shared.where("a < most AND `class` <> a").select("a", F.col("class").alias("b")).distinct(), "pairs")
    # classes that tiles connect: only within such a group can there be links
    groups = components(pairs.select("a", "b")).select(F.col("class").alias("__class"), F.col("label").alias("g"))
    sizes = groups.groupBy(F.col("g").alias("__g")).agg(F.count(F.lit(1)).alias("m"))
    groups = cut(groups.join(sizes, F.col("g") == F.col("__g")).select("__class", "g", "m"), "groups")
    reps = classes.join(groups, F.col("class") == F.col("__class")).groupBy("class", "g", "m").agg(F.min(F.struct("doc_id", "text_hash")).alias("r"))
    reps = cut(reps.select("class", "g", "m", F.col("r.doc_id").alias("__id"), F.col("r.text_hash").alias("__hash")), "reps")
    members = cut(_with_texts(docs, reps).select("class", "g", "m", "text"), "members")
    # a group beyond one block: first each tile's classes against its least one, and the pairs that were counted
    large = pairs.join(groups.where(F.col("m") > block), F.col("a") == F.col("__class")).select(*pairs.columns)
    fans = large.groupBy(F.col("a").alias("__a")).agg(F.count(F.lit(1)).alias("fans"))
    large = cut(large.join(fans, F.col("a") == F.col("__a")).select(*pairs.columns, "fans"), "large")
    links = cut(group_links(_stars(members, large, block), rule), "links")
    labels = components(links).select(F.col("class").alias("__class"), "label")
    grouped = members.select("class", "g", "m")
    if single:
        # of a large group, only what crowded tiles connect is not compared yet
        crowd = cut(components(large.where("crowded").select("a", "b")).select(F.col("class").alias("__class"), F.col("label").alias("crowd")), "crowds")
        of = crowd.groupBy(F.col("crowd").alias("__g")).agg(F.count(F.lit(1)).alias("n"))
        crowd = crowd.join(of, F.col("crowd") == F.col("__g")).select("__class", F.col("crowd").alias("g"), F.col("n").alias("m"))
        rest = members.where(F.col("m") > block).select("class").join(crowd, F.col("class") == F.col("__class")).select("class", "g", "m")
        grouped = grouped.where(F.col("m") <= block).unionByName(rest)
    left = cut(grouped.join(labels, F.col("class") == F.col("__class"), "left").select("class", "g", "m", F.coalesce("label", "class").alias("label")), "left")
    # then what is still apart in a group, all against all in blocks
    apart = left.groupBy(F.col("g").alias("__g")).agg(F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 <> l1")
    rows = left.join(apart, F.col("g") == F.col("__g")).select(F.col("class").alias("__class"), "g", "m", "label")
    rows = members.select("class", "text").join(rows, F.col("class") == F.col("__class")).select("class", "g", "m", "label", "text")
    more = cut(group_links(_blocks(rows, block), rule), "links")
    return components(links.unionByName(more))


def link_documents(docs: DataFrame, block: int = BLOCK, rule: Rule = QUERY_RULE) -> DataFrame:
    """doc_id, n_shingles, component_id, class of every row of ``docs``."""
    if rule.num * BAND_RATIO < rule.den:
        raise ValueError("sets that may link must not differ in size by more than a band")
    classes = cut(set_classes(docs, rule), "classes")
    labels = link_classes(docs, classes, block, rule).select(F.col("class").alias("__class"), "label")
    least = classes.where("`class` IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("low"))
    least = cut(least.join(labels, F.col("class") == F.col("__class"), "left").select("class", "low", F.coalesce("label", "class").alias("label")), "least")
    of = least.groupBy(F.col("label").alias("__label")).agg(F.min("low").alias("component_id"))
    of = cut(least.join(of, F.col("label") == F.col("__label")).select(F.col("class").alias("__class"), "component_id"), "components")
    full = classes.where("`class` IS NOT NULL").join(of, F.col("class") == F.col("__class")).select("doc_id", "n_shingles", "component_id", "class", "text_hash")
    empty = classes.where("`class` IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "class", "text_hash")
    return full.unionByName(empty)


def keep_one(docs: DataFrame, rule: Rule = QUERY_RULE) -> DataFrame:
    """The documents without those that link, directly or not, with one of a
    lower id; of rows equal in id and text one stays, rows without an id stay
    unless they link with a row that has one, rows without words stay."""
    docs = without(docs, "__id", "__hash", "__goes", "__text_hash", "__marked", "__repeated", "__at", "__bits")
    goes = F.col("component_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("component_id"))
    marks = link_documents(docs, rule=rule).groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    marks = marks.agg(F.max(goes).alias("__goes"), F.count(F.lit(1)).alias("n"))
    marks = cut(marks.where("__goes OR (n > 1 AND __id IS NOT NULL)").select("__id", "__hash", "__goes"), "marks")
    repeated = cut(marks.where("NOT __goes").select("__id", "__hash"), "repeated")
    key = lambda rows: rows.select(_row_key("__id", "__hash").alias("key"))
    hashed = docs.withColumn("__text_hash", F.xxhash64(text_or_empty()))
    of = _row_key("doc_id", "__text_hash")
    hashed = with_match(with_match(hashed, of, key(marks), "__marked"), of, key(repeated), "__repeated")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash"))
    # the marks follow the corpus: texts that may have one move, the others stay where they are
    single = hashed.where("__marked").join(marks.hint("merge"), same, "left_anti")
    one = hashed.where("__repeated").join(repeated.hint("merge"), same, "left_semi").dropDuplicates(["doc_id", "__text_hash"])
    kept = hashed.where("NOT __marked").unionByName(single).unionByName(one)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM w
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 90 * (x.n + y.n - shared)
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON m.a = w.doc_id
"""
