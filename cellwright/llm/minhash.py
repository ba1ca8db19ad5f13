"""Near-duplicate documents by DartMinHash over weighted word shingles.

A text's elements are its runs of five words, an element's weight being how often it occurs. Hashed
darts fall on the half-plane (weight, rank) of each element at unit density, the same for every
document; those below the element's weight hit it. The rank axis is read as far as is expected to
give enough darts (total / weight of the text), each dart belongs to one of k coordinates, and a
coordinate keeps its earliest dart. Two texts agree in a coordinate with the probability of their
weighted Jaccard similarity. Coordinates are grouped in bands and joined.

Links are verified exactly on the texts. Inside a bucket first its top, the node that meets most
others, is compared with all others; then, among the classes that this has left, every pair of
different classes that share a bucket and may be a link. So no link between different classes is
lost, and a bucket of n copies of one text costs n comparisons, not n * n.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import tokens
from .common import components, small, written

SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 24, 5
#: Nodes of a bucket up to which all its pairs of different classes are compared.
CROWD = 24
#: Texts of a crowd that share an element beyond which they are a bucket of their own, and how often that is done.
HOT, ROUNDS = 512, 3
#: How likely a pair is missed among texts of a crowd that have to share many elements; the bands miss 1e-4 at 0.8.
MISS = 1e-6


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _seed(n: int) -> np.uint64:
    return np.uint64((n * 0xD1B54A32D192ED03 + 0x8CB92BA72F3D8DD7) & 0xFFFFFFFFFFFFFFFF)


def throw_darts(elements: np.ndarray, weights: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the darts that hit the elements' weights at ranks up to until: which element, rank, identity.

    The weight axis is cut into (0, 1], (1, 2], (2, 4], (4, 8] ...; in a slab of height s, darts
    arrive along the rank axis at gaps of mean 1 / s and lie at uniform heights in it, both read from
    the element's hash. A slab that a weight cuts keeps the darts below the weight."""
    which, ranks, names = [], [], []
    low, high, slab = 0.0, 1.0, 0
    live = np.arange(len(elements))
    while len(live):
        at, who = np.zeros(len(live)), live
        base = tokens.mix(elements[live] ^ _seed(2 * slab + 1))
        turn = 0
        while len(who):
            draw = tokens.mix(base + _seed(1000 + turn))
            at = at - np.log(_uniform(draw)) / (high - low)
            near = at <= until[who]
            who, base, at, draw = who[near], base[near], at[near], draw[near]
            second = tokens.mix(draw ^ _seed(7))
            hit = low + _uniform(second) * (high - low) <= weights[who]
            which.append(who[hit])
            ranks.append(at[hit])
            names.append(second[hit])
            turn += 1
        low, high, slab = high, high * 2, slab + 1
        live = live[weights[live] > low]
    return np.concatenate(which), np.concatenate(ranks), np.concatenate(names)


def signatures_of(sets: np.ndarray, elements: np.ndarray, weights: np.ndarray, count: int, k: int) -> np.ndarray:
    """k coordinates, 32-bit values, of each of count weighted sets; sets says which set each element is
    of, in rising order, and none is empty."""
    out = np.zeros((count, k), np.uint64)
    total = np.bincount(sets, weights, count)
    todo, reach = np.arange(count), (k * np.log(k) + 2.0 * k) / total
    while len(todo):
        mine = np.isin(sets, todo) if len(todo) < count else np.ones(len(sets), bool)
        of, el, w = sets[mine], elements[mine], weights[mine]
        which, ranks, names = throw_darts(el, w, reach[of])
        slot = of[which] * k + (names % np.uint64(k)).astype(np.int64)
        # one sort: by coordinate, and within it by the share of the reach that the rank is
        order = np.argsort(slot + ranks / (reach[of][which] * 1.000001))
        first = np.ones(len(order), bool)
        first[1:] = slot[order][1:] != slot[order][:-1]
        best = order[first]
        out.reshape(-1)[slot[best]] = names[best]
        filled = np.bincount(slot[best] // k, minlength=count)
        todo = todo[filled[todo] < k]  # a coordinate without a dart: look twice as far, again from the start
        reach = reach * 2.0
    return (out >> np.uint64(32)).astype(np.uint32)


def weighted_shingles(words: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    elements, counts = np.unique(tokens.shingles(words, size), return_counts=True)
    return elements, counts.astype(np.float64)


def _text_words(column: pa.Array) -> Iterator[np.ndarray]:
    for _, _, data, offs in tokens.chunks(column):
        data = tokens.FOLD[data]
        starts, ends, first = tokens.word_spans(data, offs, tokens.ALNUM)
        hashes = tokens.span_hashes(data, starts, ends)
        for lo, hi in zip(first[:-1], first[1:], strict=True):
            yield hashes[lo:hi]


def _groups(column: pa.Array, words: int = 1 << 18) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Rows with words and their words, so many words together at least."""
    rows, texts, n = [], [], 0
    for row, one in enumerate(_text_words(column)):
        if len(one):
            rows.append(row)
            texts.append(one)
            n += len(one)
        if n >= words:
            yield rows, texts
            rows, texts, n = [], [], 0
    if rows:
        yield rows, texts


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> DataFrame:
    """(doc_id, digest, bands) of each document with a word and an id: digest is equal for equal texts,
    bands holds one 64-bit value for each band."""
    k = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, texts in _groups(batch.column(2)):
                grams = [tokens.shingles(w, size) for w in texts]
                of = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
                flat = np.concatenate(grams)
                order = np.lexsort((flat, of))
                flat, of = flat[order], of[order]
                new = np.ones(len(flat), bool)
                new[1:] = (flat[1:] != flat[:-1]) | (of[1:] != of[:-1])
                begin = np.flatnonzero(new)
                weights = np.diff(np.append(begin, len(flat))).astype(np.float64)
                sig = signatures_of(of[begin], flat[begin], weights, len(grams), k).astype(np.uint64)
                key = np.zeros((len(grams), bands), np.uint64)
                for r in range(rows):
                    key = tokens.mix(key ^ (sig[:, r::rows] + _seed(r)))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(grams) + 1) * bands, pa.int32()), pa.array(key.view(np.int64).ravel()))
                take = pa.array(place, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), lists], ["doc_id", "digest", "bands"])

    rows_in = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("digest"), "text"
    )
    return rows_in.mapInArrow(run, "doc_id long, digest string, bands array<long>")


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard similarity: sum of smaller weights over sum of larger ones."""
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    both = np.minimum(wa[ia], wb[ib]).sum()
    return float(both / (wa.sum() + wb.sum() - both))


def _sides(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """pairs (a, b, ...) with the texts of both, ta and tb, in front."""
    rest = [c for c in pairs.columns if c not in ("a", "b")]
    out = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    out = out.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    return out.select("ta", "tb", "a", "b", *rest)


def _verified(pairs: DataFrame, texts: DataFrame, least: float, size: int) -> DataFrame:
    """The pairs (a, b) whose texts are as similar as that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(_text_words(batch.column(0)), _text_words(batch.column(1)), strict=True):
                keep.append(similarity(*weighted_shingles(x, size), *weighted_shingles(y, size)) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _sides(pairs, texts).mapInArrow(run, "a long, b long")


def _against(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """pairs (a, b, c) with weight, the total weight of b, common, that of what it shares with a, and the
    elements of which b has more than a, in the order of their hashes: more, by how much: excess, and
    onward, the sum of excess from there on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight, common, more, excess = [], [], [], []
            for x, y in zip(_text_words(batch.column(0)), _text_words(batch.column(1)), strict=True):
                (a, wa), (b, wb) = weighted_shingles(x, size), weighted_shingles(y, size)
                _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
                both = np.zeros(len(b))
                both[ib] = np.minimum(wa[ia], wb[ib])
                weight.append(wb.sum())
                common.append(both.sum())
                more.append(b[wb > both].view(np.int64))
                excess.append((wb - both)[wb > both])
            onward = [np.cumsum(e[::-1])[::-1] for e in excess]
            cuts = pa.array(np.cumsum([0, *map(len, more)]), pa.int32())
            flat = lambda parts, kind: pa.array(np.concatenate([np.zeros(0, kind), *parts]))
            lists = [pa.ListArray.from_arrays(cuts, flat(parts, kind)) for parts, kind in ((more, np.int64), (excess, np.float64), (onward, np.float64))]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in (2, 3, 4)], pa.array(weight, pa.float64()), pa.array(common, pa.float64()), *lists], _FACTS)

    kinds = "a long, b long, c long, weight double, common double, more array<long>, excess array<double>, onward array<double>"
    return _sides(pairs, texts).mapInArrow(run, kinds)


_FACTS = ["a", "b", "c", "weight", "common", "more", "excess", "onward"]


def _cell(weight: Column | str) -> Column:
    """Weights of a cell differ by a fiftieth at most."""
    return F.floor(F.log(weight) / F.log(F.lit(1.02))).cast("int")


def _leading(facts: DataFrame, least: float) -> DataFrame:
    """facts with lead: of the elements that a text has more of than its reference, any other that is as similar as
    least shares one of the first lead ones, unless lead is all. What a pair has to share grows with both weights, and
    no partner is lighter than the lightest text of the reference that may be one. A pair that has to share many
    elements shares one of the lowest hashes: of these so many are taken that it misses them with probability MISS."""
    present = facts.groupBy("a", _cell("weight").alias("cell")).agg(F.min("weight").alias("low"), F.max("weight").alias("high"))
    # a few hundred cells at most, whatever the number of texts
    present = present.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("cells"))
    floor = F.col("weight") * least
    partner = F.get(F.filter("cells", lambda x: x["high"] >= floor), F.lit(0))["low"]
    need = (F.col("weight") + F.greatest(partner, floor)) * (least / (1 + least)) - F.col("common") - 1e-6
    below = 1 - F.pow(F.lit(MISS), F.array_max("excess") / F.greatest(F.col("need"), F.lit(1e-6)))
    unsigned = lambda v: F.when(v < 0, v + 2.0**64).otherwise(v.cast("double"))
    low = F.size(F.filter("more", lambda v: unsigned(v) < F.col("below") * 2.0**64))
    out = facts.join(small(written(present, "present")), "a").withColumn("need", need).withColumn("below", F.when(F.col("need") > 0, below).otherwise(1.0))
    return out.withColumn("lead", F.least(low, F.size(F.filter("onward", lambda v: v >= F.col("need"))))).drop("cells", "need", "below", "onward")


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _sides_of(part: DataFrame, side: str) -> DataFrame:
    return part.withColumnsRenamed({"b": side, "c": f"c{side}", "weight": f"w{side}", "common": f"o{side}", "left": f"l{side}"})


def _references(crowd: DataFrame) -> DataFrame:
    """(a, b, c): the nodes b, of class c, of crowded buckets (node, top, met, c), and the text a that each
    is held against: the top of its bucket, or what that top itself meets in two bands or more and more
    others meet, so that the buckets of one crowd have one reference and not one for each band."""
    seen = crowd.groupBy("node", "top").agg(F.count("*").alias("bands"), F.max("met").alias("met"))
    tops = crowd.select(F.col("top").alias("node")).distinct()
    better = seen.join(tops, "node", "left_semi").where("bands > 1 or node = top")
    better = written(better.groupBy("node").agg(F.max_by("top", F.struct("met", -F.col("top"))).alias("ref")), "references")
    once = better.withColumnsRenamed({"node": "top", "ref": "next"})
    twice = better.withColumnsRenamed({"node": "next", "ref": "a"})
    to = once.join(twice, "next", "left").select("top", F.coalesce("a", "next").alias("a"))
    return crowd.join(to, "top").select("a", F.col("node").alias("b"), "c").distinct()


def _rest(held: DataFrame, texts: DataFrame, least: float, size: int, last: bool) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of different classes c that meet in a bucket of held (band, key, node, n, top, met, c)
    and may be as similar as least; and smaller buckets (band, key, node, n) whose pairs are left to be found.

    In buckets of up to CROWD nodes that is all such pairs. In larger ones each node is held against
    a reference: two nodes that have no element in common of which both have more than the reference
    share no more than either shares with it. So a pair either shares such an element, and is
    found by the rarest one if what it may share from there on is enough, or has to pass that bound;
    a crowd of copies of the reference passes neither. Elements that more than HOT nodes have make the
    smaller buckets; the last time they are joined too."""
    few = held.where(F.col("n") <= CROWD)
    mixed = few.groupBy("band", "key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("band", "key")
    few = few.join(mixed, ["band", "key"]).select("band", "key", "node", "c")
    left, right = few.withColumnsRenamed({"node": "x", "c": "cx"}), few.withColumnsRenamed({"node": "y", "c": "cy"})
    pairs = left.join(right, ["band", "key"]).where("cx < cy").select(*_ordered("x", "y"))

    if not held.where(F.col("n") > CROWD).limit(1).count():
        return pairs.distinct(), held.select("band", "key", "node", "n").limit(0)
    many = written(_references(held.where(F.col("n") > CROWD)), "crowds")
    mixed = many.groupBy("a").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("a")
    facts = written(_against(many.join(mixed, "a"), texts, size), "facts")
    facts = written(_leading(facts, least), "leading")
    # a pair of different classes has a side that is not of the reference's class
    own = held.select(F.col("node").alias("a"), F.col("c").alias("ca")).distinct()
    facts = facts.join(own, "a", "left").withColumn("stray", ~F.col("c").eqNullSafe(F.col("ca"))).drop("ca")

    # only texts of which another class has a leading element too are compared by all of theirs
    head = facts.select("a", "b", "c", F.explode(F.slice("more", 1, F.col("lead"))).alias("e"))
    met = head.groupBy("a", "e").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("a", "e")
    able = written(head.join(met, ["a", "e"]).select("a", "b").distinct(), "able")
    part = facts.join(able, ["a", "b"], "left_semi")
    part = part.select("a", "b", "c", "stray", "weight", "common", F.explode(F.arrays_zip("more", "excess")).alias("z"))
    part = part.select("a", "b", "c", "stray", "weight", "common", F.col("z.more").alias("e"), F.col("z.excess").alias("excess"))
    met = part.groupBy("a", "e").agg(F.count("*").alias("m"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
    # rare elements first: from the first one that a pair shares on, it shares no more than is left
    onward = Window.partitionBy("a", "b").orderBy("m", "e").rowsBetween(0, Window.unboundedFollowing)
    part = part.join(met.select("a", "e", "m"), ["a", "e"]).withColumn("left", F.sum("excess").over(onward))
    part = part.where(F.col("common") + F.col("left") >= least * F.col("weight"))
    part = written(part.select("a", "b", "c", "stray", "weight", "common", "e", "m", "left"), "elements")
    rare = part if last else part.where(F.col("m") <= HOT)
    most = F.least("ox", "oy") + F.least("lx", "ly")
    enough = most >= least * (F.col("wx") + F.col("wy") - most)
    left, right = _sides_of(rare.where("stray").drop("stray", "m"), "x"), _sides_of(rare.drop("stray", "m"), "y")
    by_element = left.join(right, ["a", "e"]).where((F.col("cx") != F.col("cy")) & enough).select(*_ordered("x", "y"))

    # without such an element: what a stray shares with the reference bounds the weight of its partners
    near = facts.where(F.col("common") >= least * F.col("weight")).drop("more", "excess", "lead")
    widest = F.col("common") * ((1 + least) / least) - F.col("weight")
    cells = F.sequence(_cell(F.col("weight") * least) - 1, _cell(F.greatest(widest, F.col("weight") * least)) + 1)
    left = _sides_of(near.where("stray").withColumn("cell", F.explode(cells)).drop("stray"), "x")
    right = _sides_of(near.withColumn("cell", _cell(F.col("weight"))).drop("stray"), "y")
    most = F.least("ox", "oy")
    bound = most >= least * (F.col("wx") + F.col("wy") - most)
    by_bound = left.join(right, ["a", "cell"]).where((F.col("cx") != F.col("cy")) & bound).select(*_ordered("x", "y"))

    hot = part.where(F.col("m") > HOT) if not last else part.limit(0)
    hot = hot.select(F.lit(-1).alias("band"), F.xxhash64("a", "e").alias("key"), F.col("b").alias("node"), F.col("m").alias("n"))
    return pairs.union(by_element).union(by_bound).distinct(), hot


def _classes(shared: DataFrame, texts: DataFrame, least: float, size: int) -> DataFrame:
    """(node, component) of the nodes that buckets shared (band, key, node, n) link."""
    links = tried = None
    for turn in range(ROUNDS):
        # a bucket's top is the node that meets most others over all bands: what near copies are copies of
        met = shared.groupBy("node").agg(F.sum("n").alias("met"))
        rows = shared.join(met, "node")
        tops = rows.groupBy("band", "key").agg(F.max_by("node", F.struct("met", -F.col("node"))).alias("top"), F.max("met").alias("met"))
        shared = written(shared.join(tops, ["band", "key"]), "tops")
        first = shared.where("node <> top").select(*_ordered("node", "top")).distinct()
        first = written(first if tried is None else first.join(tried, ["a", "b"], "left_anti"), "pairs")
        found = written(_verified(first, texts, least, size), "links")
        links = found if links is None else links.union(found)
        group = written(components(links), "classes")
        held = shared.join(group, "node", "left").select("band", "key", "node", "top", "n", "met", F.coalesce("component", "node").alias("c"))
        rest, shared = _rest(written(held, "held"), texts, least, size, turn == ROUNDS - 1)
        tried = first if tried is None else tried.union(first)
        rest = written(rest.join(tried, ["a", "b"], "left_anti"), "rest")
        more = written(_verified(rest, texts, least, size), "links")
        left = turn < ROUNDS - 1 and shared.limit(1).count()
        if more.limit(1).count():
            links, tried = links.union(more), tried.union(rest)
            group = group if left else written(components(links), "classes")
        if not left:
            return group


def near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, class_id, kept) for every row of docs (doc_id, text, ...), see text_classes."""
    return text_classes(docs, **how).drop("digest")


def text_classes(docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> DataFrame:
    """(doc_id, digest, class_id, kept) for every row of docs (doc_id, text, ...), digest being the text's.

    class_id is the smallest doc_id of the documents that links of similarity >= least reach, kept
    whether it is the document's own. Equal texts are one node, headed by the smallest of their ids, so
    groups of exact copies of any size cost nothing after that. A document without words or with a
    null text is a class of its own and kept; a row without doc_id has a null class and is kept.
    Rows that repeat a doc_id each get the class of their own text. Other columns are ignored; an
    empty table gives an empty one."""
    marks = written(signatures(docs, bands, rows, size), "darts")
    heads = marks.groupBy("digest").agg(F.min("doc_id").alias("head"))
    heads = written(heads.select(F.monotonically_increasing_id().alias("node"), "digest", "head"), "heads")
    nodes = marks.join(heads, "digest").where("doc_id = head")
    keys = nodes.select("node", F.posexplode("bands").alias("band", "key")).distinct()
    keys = written(keys, "bands")

    sizes = keys.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(keys.join(sizes, ["band", "key"]), "buckets")
    wanted = written(heads.join(small(shared.select("node").distinct()), "node", "left_semi"), "wanted")
    named = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("head"), "text", F.md5("text").alias("digest"))
    texts = named.join(small(wanted), ["digest", "head"])
    texts = written(texts.dropDuplicates(["node"]).select("node", "text"), "texts")
    group = _classes(shared, texts, least, size)

    member = heads.join(group, "node")
    first_id = member.groupBy("component").agg(F.min("head").alias("first_id"))
    member = member.join(first_id, "component").select("node", "first_id")
    named = heads.join(member, "node", "left").select("digest", F.coalesce("first_id", "head").alias("class_id"))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("digest"))
    out = out.join(named, "digest", "left").select("doc_id", "digest", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"))
    return out.select("doc_id", "digest", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs of which near_duplicates keeps the document, with their columns."""
    gone = text_classes(docs, **how).where("not kept").select(F.col("doc_id").alias("_gone"), F.col("digest").alias("_digest")).distinct()
    same = (docs["doc_id"].cast("long") == gone["_gone"]) & (F.md5(docs["text"]) == gone["_digest"])
    return docs.join(gone, same, "left_anti")
