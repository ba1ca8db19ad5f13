"""Line deduplication by a segment-partition edit join.

Two lines within t edits share at least one of the t + 1 segments that the shorter is cut into, at
nearly the same place. Each distinct line puts its segments into an index by length, and probes the
indexes of its own and the t shorter lengths with the few substrings that can match (those that are
left and right of the shared segment within the edits that are left to them). Candidates are verified
by a banded bit-parallel edit distance, after a common beginning and end is cut off.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, fresh, shuffled, small, written

#: Lines of MIN_CHARS characters may differ by EDITS edits, shorter ones by fewer in proportion.
EDITS, MIN_CHARS = 2, 20
#: Lines that share a key beyond which finer keys are used, and the segments of these.
HOT, FINE_PARTS = 24, 8
#: Letters that are counted before candidates are verified.
LETTERS = "aeinorstdhlu"
_LATE = 9223372036854775807
_LINES = 1 << 32
_CROWDED = -1


def segment(length: Column, i: Column, parts: int) -> tuple[Column, Column]:
    """Start, from 0, and size of segment i of a line of that length: the last ones are longer by one."""
    size, longer = F.floor(length / parts).cast("int"), parts - length % parts
    return size * i + F.greatest(F.lit(0), i - longer), size + F.when(i >= longer, 1).otherwise(0)


def keys(lines: DataFrame, edits: int, index_only: bool = False) -> DataFrame:
    """(id, key): the index entries and the probes of lines (id, line, size). A probe takes a
    length that is less by 0 to edits, a segment i, and a shift of its place that leaves enough edits
    for what is left and right of it; the one that moves nothing is the index entry."""
    probes = [
        F.struct(F.lit(less).alias("less"), F.lit(i).alias("i"), F.lit(shift).alias("shift"))
        for less in range(edits + 1) for i in range(edits + 1)
        for shift in range(max(-i, less - (edits - i)), min(i, less + edits - i) + 1)
        if not index_only or less == shift == 0
    ]
    # few and short expressions, as what longer ones are compiled to is too long to be compiled in turn; a probe that
    # begins before the line or ends after it is some other piece, which costs a candidate at most
    rows = lines.select("id", "line", "size", F.explode(F.array(*probes)).alias("p")).where("size - p.less > %d" % edits)
    length = F.col("size") - F.col("p.less")
    start, n = segment(length, F.col("p.i"), edits + 1)
    return rows.select("id", F.xxhash64("p.i", length, F.substring("line", start + F.col("p.shift") + 1, n)).alias("key"))


def marks(line: Column) -> Column:
    """How often each of LETTERS occurs, modulo 10, in five bits each of which the next number changes one."""
    count = lambda x: F.octet_length(line) - F.octet_length(F.replace(line, x))
    codes = F.array(*[F.lit(v).cast("long") for v in (0, 1, 3, 7, 15, 31, 30, 28, 24, 16)])
    letters = F.array(*[F.lit(x) for x in LETTERS])
    return F.aggregate(letters, F.lit(0).cast("long"), lambda m, x: m * 32 + F.get(codes, count(x) % 10))


def apart(x: Column, y: Column) -> Column:
    """By how much the counts of two marks differ in all, or less: an edit adds two at most."""
    return F.bit_count(x.bitwiseXOR(y))


def fine_keys(lines: DataFrame, parts: int) -> DataFrame:
    """(id, key, indexed, marks): like keys, for up to two edits and lines (id, line, size, marks) that share
    a segment with very many others: of parts
    segments all but two must be equal, as two edits touch two. What is left of a line without two
    segments is its beginning, a middle that may have moved by s, and its end."""
    probes = [
        F.struct(*[F.lit(v).alias(k) for k, v in (("b", b), ("c", c), ("less", less), ("s", s))])
        for b in range(parts) for c in range(b + 1, parts)
        for less in range(3) for s in range(-2, 3) if abs(s) + abs(less - s) <= 2
    ]
    rows = lines.select("id", "line", "size", "marks", F.explode(F.array(*probes)).alias("p"))
    length = F.col("size") - F.col("p.less")
    (b0, bn), (c0, cn) = (segment(length, F.col(f"p.{k}"), parts) for k in "bc")
    rows = rows.select("id", "line", "size", "marks", "p", length.alias("length"), b0.alias("b0"), (b0 + bn).alias("b1"), c0.alias("c0"), (c0 + cn).alias("c1"))
    rows = rows.where("b1 + p.s >= 0 and c0 + p.s <= size and length > 2")
    key = F.xxhash64(
        "p.b", "p.c", "length", F.substring("line", F.lit(1), F.col("b0")),
        F.substring("line", F.col("b1") + F.col("p.s") + 1, F.col("c0") - F.col("b1")), F.right("line", F.col("length") - F.col("c1")),
    )
    return rows.select("id", key.alias("key"), F.expr("p.less = 0 and p.s = 0").alias("indexed"), "marks")


def _let(fields: dict[str, Column], use: Callable[[Column], Column]) -> Column:
    """use() of the fields' values, each of which is computed once."""
    return F.transform(F.array(F.struct(*[v.alias(k) for k, v in fields.items()])), use)[0]


def _shared(x: Column, y: Column, part: Callable[[Column, Column], Column], leave: int) -> Column:
    """How many characters x and y share at one end, by halving; so many are left of the shorter."""
    most = F.least(F.length(x), F.length(y)) - leave
    steps = F.array(*[F.lit(1 << k) for k in range(20, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda n, s: F.when(n + s > most, n).when(part(x, n + s) == part(y, n + s), n + s).otherwise(n))


def _stripped(x: Column, y: Column, leave: int, use: Callable[[Column, Column], Column]) -> Column:
    """use() of x and y without the beginning and then the end that they share, but for some characters."""
    lead = _shared(x, y, F.left, leave)
    after = lambda s: {"x": F.substr(s["x"], s["n"] + 1), "y": F.substr(s["y"], s["n"] + 1)}
    before = lambda s: {c: F.left(s[c], F.length(s[c]) - s["n"]) for c in "xy"}
    return _let({"x": x, "y": y, "n": lead}, lambda s: _let(after(s), lambda t: _let(
        {"x": t["x"], "y": t["y"], "n": _shared(t["x"], t["y"], F.right, leave)}, lambda u: _let(before(u), lambda v: use(v["x"], v["y"]))
    )))


def within(x: Column, y: Column, edits: int) -> Column:
    """Whether two texts, both of more characters than edits, are within that many edits.

    Column by column of the table of distances, the differences along a band of 2 * edits + 2 rows
    are held as bits of two numbers and updated by a few operations; a count of distance follows the
    band's lower edge and then the last row. Once the count cannot come back, nothing more is done."""
    wide = 2 * edits + 2
    mask, top = (1 << wide) - 1, 1 << (wide - 1)
    zeros = F.lit(bytearray(4 * wide))

    def step(s: Column, state: Column, i: Column) -> Column:
        c = F.substring(s["b"], 4 * i + 1, F.lit(4))
        same = F.lit(0)
        for k in range(wide):
            p = i + (edits - (wide - 1) + k + wide)  # place in a, whose text begins at wide
            same = same + F.when(F.substring(s["a"], 4 * p + 1, F.lit(4)) == c, 1 << k).otherwise(0)

        def move(t: Column) -> Column:
            vp, vn, d0 = t["vp"], t["vn"], t["d0"]
            hp = vn.bitwiseOR(d0.bitwiseOR(vp).bitwiseXOR(F.lit(mask)))
            hn, down = d0.bitwiseAND(vp), F.shiftright(d0, 1)
            # the last row's bit moves down by one each time
            at = F.lit(wide - 2) - (i - F.greatest(s["m"] - edits, F.lit(0)))
            bit = F.get(F.array(*[F.lit(1 << k) for k in range(wide)]), at)
            one = lambda v: F.when(v.bitwiseAND(bit) != 0, 1).otherwise(0)
            edge = F.when(d0.bitwiseAND(F.lit(top)) != 0, 0).otherwise(1)
            d = t["d"] + F.when(i < s["m"] - edits, edge).otherwise(one(hp) - one(hn))
            up = hn.bitwiseOR(down.bitwiseOR(hp).bitwiseXOR(F.lit(mask)))
            return F.struct(up.alias("vp"), down.bitwiseAND(hp).alias("vn"), d.alias("d"))

        def bits(t: Column) -> Column:
            vp, vn, e = t["vp"], t["vn"], t["e"]
            d0 = (e.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(e).bitwiseOR(vn).bitwiseAND(F.lit(mask))
            return _let({"vp": vp, "vn": vn, "d": t["d"], "d0": d0}, move)

        new = _let({"vp": state["vp"], "vn": state["vn"], "d": state["d"], "e": same}, bits)
        return F.when(state["d"] > 3 * edits + 1, state).otherwise(new)

    def run(s: Column) -> Column:
        begin = F.struct(F.lit((mask << (wide - edits - 1)) & mask).alias("vp"), F.lit(0).alias("vn"), F.lit(edits).alias("d"))
        return F.aggregate(F.sequence(F.lit(0), s["n"] - 1), begin, lambda state, i: step(s, state, i))["d"] <= edits

    # four bytes a character, so that any is found in constant time; zeros around stand for no character
    fields = {"a": F.concat(zeros, F.encode(x, "UTF-32"), zeros), "b": F.encode(y, "UTF-32"), "m": F.length(x), "n": F.length(y)}
    return F.when(F.abs(F.length(x) - F.length(y)) > edits, False).otherwise(_let(fields, run))


def _met(rows: DataFrame, index: DataFrame, most: int | None = None) -> DataFrame:
    """Pairs that share a key; with most, only those whose marks differ by no more. Neither side is broadcast: a line has many keys."""
    own = ["marks"] if most is not None else []
    left = index.select("key", F.col("id").alias("i"), *own)
    right = rows.select("key", F.col("id").alias("p"), *[F.col(c).alias("others") for c in own])
    near = F.col("i") != F.col("p")
    if own:
        near = near & (apart(F.col("marks"), F.col("others")) <= most)
    return shuffled(left).join(right, "key").where(near).select(F.least("i", "p").alias("a"), F.greatest("i", "p").alias("b"))


def candidates(lines: DataFrame, edits: int, hot: int = HOT) -> DataFrame:
    """(a, b), a < b: pairs of lines (id, line, size) that share a key. Keys of more than hot lines are
    not joined; the lines that have one are instead joined among themselves by finer keys, which every
    pair within edits shares too. That holds for up to two edits; for more all keys are joined."""
    rows, index = keys(lines, edits), keys(lines, edits, index_only=True)
    if edits > 2:
        return _met(rows, index).distinct()
    crowded = written(index.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("key"), "crowded")
    # a crowded key is met once, as line -1, which tells the lines that have or probe one
    index = index.join(small(crowded), "key", "left_anti").unionByName(crowded.select("key", F.lit(_CROWDED).cast("long").alias("id")))
    met = written(_met(rows, index).distinct(), "met")
    pairs, ids = met.where(F.col("a") != _CROWDED), met.where(F.col("a") == _CROWDED).select(F.col("b").alias("id"))
    if not ids.limit(1).count():
        return pairs
    # written, so that the long code of the finer keys runs over these lines alone
    picked = written(lines.join(small(ids), "id", "left_semi").withColumn("marks", marks(F.col("line"))), "crowded-text")
    fine = fine_keys(picked, FINE_PARTS)
    return pairs.union(_met(fine, fine.where("indexed"), 2 * edits)).distinct()


def edit_links(lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """(a, b), a < b: the ids of distinct lines (id, line, size) within that many edits. Lines of no
    more characters than edits link with nothing. The texts of candidates alone are joined to them, and only those
    whose letter counts may be within edits are verified."""
    pairs = written(candidates(lines, edits), "candidates")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    texts = lines.select("id", "line").join(small(written(ids, "candidate-lines")), "id", "left_semi")
    texts = written(texts.withColumn("marks", marks(F.col("line"))), "candidate-text")
    both = pairs
    for c, text in (("a", "x"), ("b", "y")):
        both = both.join(shuffled(texts.select(F.col("id").alias(c), F.col("line").alias(text), F.col("marks").alias(f"marks_{c}"))), c)
    both = both.where(apart(F.col("marks_a"), F.col("marks_b")) <= 2 * edits)
    close = _stripped(F.col("x"), F.col("y"), edits + 1, lambda x, y: within(x, y, edits))
    return both.where(close).select("a", "b")


def scaled_links(lines: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(a, b), a < b: the ids of distinct lines (id, line, size) within the edits that the shorter one's
    length allows: edits from min_chars characters on, below that edits * size / min_chars, rounded down.
    There is a join for each number of edits, of the lengths that it can link."""
    out = lines.sparkSession.createDataFrame([], "a long, b long")
    for e in range(1, edits + 1):
        least = max(-(-e * min_chars // edits), e + 1)
        if e == edits:
            out = out.union(edit_links(lines.where(F.col("size") >= least), e))
            continue
        beyond = -(-(e + 1) * min_chars // edits)  # a length that allows one more edit
        some = lines.where((F.col("size") >= least) & (F.col("size") < beyond + e))
        links = edit_links(some, e)
        for c in "ab":
            links = links.join(some.select(F.col("id").alias(c), F.col("size").alias(f"size_{c}")), c)
        out = out.union(links.where(F.least("size_a", "size_b") < beyond).select("a", "b"))
    return out


def _lines(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", F.xxhash64("text").alias("key"), F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line"))
    rows = rows.where("line is not null").withColumn("line", F.trim("line"))
    return rows.select("doc_id", "key", "line_no", "line", F.length("line").alias("size"))


def line_classes(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, key, line_no, class_doc, class_line, n_links, kept) for every line of every document.

    Lines are what newlines separate, without spaces around. Lines of any length but none that are equal
    or linked by scaled_links, directly or over others, are a class; class_doc and class_line name its
    first line, of the smallest doc_id and line number, the only one kept. n_links is how many other
    distinct lines are linked. Empty lines are classes of their own and kept. A null text has no line,
    an empty one a single empty line. Lines of rows without doc_id
    come last. Rows that repeat doc_id and text are copies: each has a kept line where one has. key is
    a hash of the text, for rows that share only a doc_id."""
    lines = _lines(docs)
    able = lines.where(F.col("size") > 0)
    # document and line number as one number, so that the first place is a plain minimum
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LATE))
    place = order.cast("decimal(20,0)") * F.lit(_LINES).cast("decimal(11,0)") + F.col("line_no").cast("decimal(10,0)")
    one = able.groupBy("line").agg(F.min(place).alias("place"), F.count("*").alias("n"))
    one = written(one.select(F.monotonically_increasing_id().alias("id"), "line", F.length("line").alias("size"), "place", "n"), "lines")
    links = written(scaled_links(one.select("id", "line", "size"), edits, min_chars), "links")
    ends = links.select(F.col("a").alias("id")).union(links.select("b")).groupBy("id").agg(F.count("*").alias("n_links"))
    linked = written(components(links).withColumnRenamed("node", "id").join(shuffled(ends), "id"), "linked")
    mark = [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")]
    # no text goes along, as beyond a few linked lines this is a shuffle of all
    shared = one.select("id", "place", "n", *mark).join(small(linked), "id", "left").where("n > 1 or component is not null")
    shared = shared.withColumn("component", F.coalesce("component", "id"))
    least = shared.groupBy("component").agg(F.min("place").alias("first"))
    line_no = F.pmod("first", F.lit(_LINES).cast("decimal(11,0)"))
    shared = shared.join(least, "component").select(
        "h1", "h2", ((F.col("first") - line_no) / F.lit(_LINES).cast("decimal(11,0)")).cast("long").alias("class_doc"), line_no.cast("int").alias("class_line"), "n_links"
    )
    shared = written(shared, "shared")
    out = lines.select("doc_id", "key", "line_no", order.alias("doc"), *mark).join(shuffled(shared), ["h1", "h2"], "left")
    alone = F.col("class_doc").isNull()
    kept = alone | ((F.col("doc") == F.col("class_doc")) & (F.col("line_no") == F.col("class_line")))
    real = F.when(F.col("class_doc") != _LATE, F.col("class_doc"))
    return out.select(
        F.col("doc_id").cast("long").alias("doc_id"), "key", "line_no", F.when(alone, F.col("doc_id").cast("long")).otherwise(real).alias("class_doc"),
        F.when(alone, F.col("line_no")).otherwise(F.col("class_line")).alias("class_line"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), kept.alias("kept"),
    )


def drop_repeated_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """docs without the lines that line_classes does not keep, with the columns of docs; n_chars, if
    there is one, is counted again. A document that loses lines and has no other text left is dropped, as all of it
    is kept elsewhere; others stay, those with a null or empty text too."""
    of, key_of, gone_at, new_text = fresh(docs, "of", "key", "gone", "left")
    gone = line_classes(docs, edits, min_chars).where("not kept").groupBy(F.col("doc_id").alias(of), F.col("key").alias(key_of))
    gone = gone.agg(F.collect_set("line_no").alias(gone_at))
    key = F.xxhash64(docs["text"])
    both = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone[of]) & (key == gone[key_of]), "left")
    lines, cut = F.split(docs["text"], "\n"), F.col(gone_at)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), cut)
    text = F.when(cut.isNull(), docs["text"]).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    both = both.withColumn(new_text, text).where(cut.isNull() | (F.trim(F.col(new_text)) != ""))
    new = {"text": F.col(new_text)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(cut.isNull(), docs["n_chars"]).otherwise(F.length(new_text).cast("long"))
    return both.select(*[new[c].alias(c) if c in new else docs[c] for c in docs.columns])
