"""Benchmark decontamination: documents are scanned for the word windows of benchmark items.

The windows of all items form a hash set; every window of every document probes it once, inside one
generated loop over the words of whole texts, and a probe that finds its hash is verified word for
word. The set is broadcast if its checked size allows, else joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import BROADCAST_ROWS, ascii_lower, fresh, small, written

WINDOW = 10
#: Fixed pattern: what separates words once A-Z is lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> Column:
    """The words of a text, of a null none."""
    return F.filter(F.split(ascii_lower(F.col(text)), SEPARATORS), lambda w: w != "")


def _parts(text: str) -> Column:
    """Like words_of, with an empty word first if the text begins with a separator: that costs no pass."""
    return F.split(ascii_lower(F.col(text)), SEPARATORS)


def item_windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """(item_id, size, hash, gram) of each window of each item; an item of fewer words, but not none,
    is one window."""
    words = benchmark.select("item_id", words_of("text").alias("w")).where("size(w) > 0")
    words = words.select("item_id", "w", F.least(F.size("w"), F.lit(width)).alias("size"))
    at = words.select("item_id", "size", "w", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)).alias("i"))
    grams = at.select("item_id", "size", F.array_join(F.slice("w", F.col("i"), F.col("size")), " ").alias("gram")).distinct()
    return grams.select("item_id", "size", F.xxhash64(F.split("gram", " ")).alias("hash"), "gram")


def hits(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Two tables: (key, doc_id, n_words, pos, size, gram_id), one row of every document with a null
    gram_id and one for each window that occurs, pos counting words from 0; and (gram_id, item_id)."""
    grams = written(item_windows(benchmark, width), "grams")
    sets = grams.groupBy("size", "hash", "gram").agg(F.count("*").alias("n")).select(
        "size", "hash", "gram", F.sha2("gram", 256).alias("gram_id")
    )
    sizes = [r["size"] for r in grams.select("size").distinct().collect()]  # at most width of them
    items = grams.select(F.sha2("gram", 256).alias("gram_id"), "item_id")

    text = docs.select(F.xxhash64(F.col("doc_id").cast("string"), "text").alias("key"), F.col("doc_id"), _parts("text").alias("w"))
    at = text.select("key", "doc_id", "w", F.posexplode_outer("w").alias("i", "word"))
    lead = F.when(F.get("w", F.lit(0)) == "", 1).otherwise(0)
    total = F.coalesce(F.size("w"), F.lit(0)) - lead - F.when(
        (F.size("w") > 1) & (F.get("w", F.size("w") - 1) == ""), 1
    ).otherwise(0)
    total = F.when(F.col("w").isNull(), 0).otherwise(total)
    out = None
    for n, size in enumerate(sizes or [width]):
        named = sets.where(F.col("size") == size).select("hash", "gram", "gram_id")
        probe = at.withColumn("hash", F.xxhash64(F.array(*[F.get("w", F.col("i") + k) for k in range(size)])) if size > 1 else F.xxhash64(F.array("word")))
        fits = F.col("i") + size <= F.size("w")
        same = F.concat_ws(" ", *[F.get("w", F.col("i") + k) for k in range(size)]) == F.col("gram")
        place = [total.cast("long").alias("n_words"), (F.col("i") - lead).alias("pos"), F.lit(size).alias("size")]
        if named.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
            # what is shuffled of a window is its hash, its place and its own words
            grams_of = F.concat_ws(" ", *[F.get("w", F.col("i") + k) for k in range(size)]).alias("gram")
            windows = probe.where(fits).select("key", "doc_id", *place, "hash", grams_of)
            found = windows.join(named, ["hash", "gram"]).select("key", "doc_id", "n_words", "pos", "size", "gram_id")
            if n == 0:
                first = at.where(F.coalesce(F.col("i") == 0, F.lit(True))).select("key", "doc_id", *place, F.lit(None).cast("string").alias("gram_id"))
                found = found.union(first)
            out = found if out is None else out.union(found)
            continue
        found = probe.join(F.broadcast(named), (probe["hash"] == named["hash"]) & fits & same, "left")
        if n == 0:
            found = found.where(F.col("gram_id").isNotNull() | F.coalesce(F.col("i") == 0, F.lit(True)))
        else:
            found = found.where(F.col("gram_id").isNotNull())
        found = found.select("key", "doc_id", *place, "gram_id")
        out = found if out is None else out.union(found)
    return out, items


def spans(found: DataFrame) -> DataFrame:
    """(key, doc_id, begin, end): the words [begin, end) that windows cover, overlapping ones merged."""
    order = Window.partitionBy("key", "doc_id").orderBy("pos")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ends = found.where("gram_id is not null").select("key", "doc_id", "pos", (F.col("pos") + F.col("size")).alias("stop")).distinct()
    new = ends.withColumn("fresh", F.coalesce((F.col("pos") > F.max("stop").over(before)).cast("int"), F.lit(1)))
    runs = new.withColumn("run", F.sum("fresh").over(order.rangeBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("key", "doc_id", "run").agg(F.min("pos").alias("begin"), F.max("stop").alias("end")).drop("run")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each document.

    A document word that any occurrence of a window covers is hit; n_items counts the items of which
    a window occurs, and items_sha256 is of their ids, sorted as strings and joined by commas. A null
    text has no words, items with a null or empty text no windows, an empty benchmark finds nothing.
    Each row of docs gives a row, rows that repeat doc_id and text as well; rows that share only a doc_id
    are judged apart. Texts may be of any length; other columns are ignored."""
    found, items = hits(docs, benchmark, width)
    found = written(found, "hits")
    base = found.where("gram_id is null or pos <= 0").groupBy("key", "doc_id").agg(F.max("n_words").alias("n_words"))
    covered = spans(found).groupBy("key", "doc_id").agg(F.sum(F.col("end") - F.col("begin")).cast("long").alias("n_hit"))
    grams = found.where("gram_id is not null").select("key", "doc_id", "gram_id").distinct()
    named = grams.join(small(items), "gram_id").select("key", "doc_id", F.col("item_id").cast("string").alias("item")).distinct()
    named = named.groupBy("key", "doc_id").agg(F.count("item").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("ids"))
    stats = covered.join(named, (covered["key"] == named["key"]) & covered["doc_id"].eqNullSafe(named["doc_id"]))
    stats = stats.select(covered["key"].alias("k"), covered["doc_id"].alias("d"), "n_hit", "n_items", "ids")
    out = base.join(stats, (base["key"] == stats["k"]) & base["doc_id"].eqNullSafe(stats["d"]), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    each = docs.select(F.xxhash64(F.col("doc_id").cast("string"), "text").alias("own_key"), F.col("doc_id").alias("own_id"))
    out = each.join(out, (F.col("own_key") == base["key"]) & F.col("own_id").eqNullSafe(base["doc_id"]))
    return out.select(
        F.col("own_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, remove: str = "documents") -> DataFrame:
    """docs without contamination, with the columns of docs.

    remove="documents" drops each row with a hit; remove="spans" takes the hit words out of its text,
    which is then its remaining words, lower-cased and joined by spaces; rows without a hit stay as
    they are, nulls included."""
    found, _ = hits(docs, benchmark, width)
    found = found.where("gram_id is not null")
    key = F.xxhash64(docs["doc_id"].cast("string"), docs["text"])
    key_of, doc_of, cut_of = fresh(docs, "key_of", "doc_of", "cut_of")
    if remove == "documents":
        bad = found.select(F.col("key").alias(key_of), F.col("doc_id").alias(doc_of)).distinct()
        return docs.join(bad, (key == bad[key_of]) & docs["doc_id"].eqNullSafe(bad[doc_of]), "left_anti")
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")
    cut = spans(found).groupBy(F.col("key").alias(key_of), F.col("doc_id").alias(doc_of)).agg(
        F.flatten(F.collect_list(F.sequence("begin", F.col("end") - 1))).alias(cut_of)
    )
    both = docs.join(cut, (key == cut[key_of]) & docs["doc_id"].eqNullSafe(cut[doc_of]), "left")
    w = words_of("text")
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(w) - 1), F.col(cut_of)), lambda i: F.get(w, i))
    text = F.when(F.col(cut_of).isNull(), F.col("text")).otherwise(F.array_join(left, " "))
    return both.select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns])
