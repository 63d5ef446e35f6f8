"""Spelling variants of the words of a corpus, found with asymmetric q-chunks.

Two words are near if one insertion, deletion or replacement of a code point makes them equal. Of a
pair, the word that is not longer is cut into two disjoint chunks, its halves; one edit leaves at least
one of them whole. The other word gives its positional grams of the chunks' lengths: a chunk that was
left whole is found there at its place or, behind an inserted code point, one further. Grams at other
places can meet no chunk, so they are not sent. Chunks and grams are joined, and the pairs verified.

What a shared chunk leaves open is a shorter pair of words with one edit. Where a chunk is so common that
its pairs exceed ``CROWD``, the open parts are therefore cut in halves in the same way, until few words
share a key or one code point is open; that loses no pair, and bounds what a key can bring.

Defined results: NULL and empty texts have no words; a NULL id is written as ``null`` where it is hashed;
repeated rows count; of near words with equal counts the first in code-point order is the form; a word
that is near to none has neither form nor root but itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.session import cut

LEAST = 7  # code points of a word
OFTEN = 2  # occurrences of a word
TIMES = 10  # how much commoner a form is
NOISE = 31  # one in so many runs loses a code point
CROWD = 512  # pairs a key may bring before its open parts are cut again
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, run): the maximal runs of at least ``least`` Latin letters of every text, A-Z in lower case."""
    found = F.regexp_extract_all("text", F.lit("([A-Za-zÀ-ÿ]{%d,})" % least), 1)
    rows = docs.select("doc_id", F.explode(found).alias("run"))
    return rows.withColumn("run", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run")))


def noisy(rows: DataFrame) -> DataFrame:
    """(word): the runs of (doc_id, run), of which those that the hash chooses lack one code point."""
    named = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("run"))
    hashed = rows.withColumn("h", F.crc32(named.cast("binary")))
    at = F.pmod("h", F.length("run")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % NOISE == 0, shorter).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least: int = LEAST, often: int = OFTEN) -> DataFrame:
    """(word, n) of the words that are long and common enough."""
    return words.filter(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= often)


def _halved(rows: DataFrame) -> DataFrame:
    """Each row once per half of its open part ``[lo, hi)``: the half joins the key, the rest stays open.

    ``more`` is what the word has more code points than the chunks' word.
    """
    free = F.col("hi") - F.col("lo") - F.col("more")
    half = F.floor(free / 2).cast("int")
    piece = lambda lo, n: F.col("word").substr(lo + 1, n)
    first = F.struct(
        F.xxhash64("key", F.lit(0), piece(F.col("lo"), half)).alias("key"), (F.col("lo") + half).alias("lo"), F.col("hi").alias("hi")
    )
    behind = F.col("lo") + half + F.col("more")
    second = F.struct(F.xxhash64("key", F.lit(1), piece(behind, free - half)).alias("key"), F.col("lo").alias("lo"), behind.alias("hi"))
    parts = rows.withColumn("part", F.explode(F.array(first, second)))
    return parts.select("part.key", "whole", "more", "word", "n", "part.lo", "part.hi")


def near_pairs(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, n_a, b, n_b): every pair of near words of (word, n) once; a is not longer than b."""
    size = F.length("word")
    role = lambda whole, more: F.struct(
        F.xxhash64(size - more).alias("key"), F.lit(whole).alias("whole"), F.lit(more).alias("more"), F.lit(0).alias("lo"), size.alias("hi")
    )
    # As the word of the chunks, and as the word of the grams for partners as long or one shorter.
    roles = F.array(role(True, 0), role(False, 0), role(False, 1))
    rows = words.select("word", "n", F.explode(roles).alias("r")).select("r.*", "word", "n")
    found = None
    while True:
        keyed = _halved(rows)
        hashed = F.xxhash64("word")
        sides = keyed.groupBy("key").agg(
            F.count_if("whole").alias("chunks"), F.count_if(~F.col("whole")).alias("grams"), (F.min(hashed) < F.max(hashed)).alias("differ")
        )
        pairs = sides.filter("chunks > 0 and grams > 0 and differ").select("key", (F.col("chunks") * F.col("grams")).alias("pairs"))
        shared = cut(keyed.join(pairs, "key"))
        again = (F.col("pairs") > crowd) & (F.col("hi") - F.col("lo") - F.col("more") > 1)
        quiet = shared.filter(~again)
        a = quiet.filter("whole").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
        b = quiet.filter("not whole").select("key", "more", F.col("word").alias("b"), F.col("n").alias("n_b"))
        near = a.join(b, "key").filter("(more = 1 or a < b) and levenshtein(a, b, 1) = 1").select("a", "n_a", "b", "n_b")
        found = near if found is None else found.unionByName(near)
        rows = shared.filter(again)
        if rows.isEmpty():
            return found.distinct()  # a doubled code point where halves meet leaves both whole


def _last(forms: DataFrame) -> DataFrame:
    """(word, root) for the rows of (word, form): from form to form to the last, twice as far every round."""
    reached = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        stepped = cut(reached.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), "beyond"))
        reached = stepped.select("word", "root")
        if stepped.filter("beyond is not null").isEmpty():
            return reached


def group_variants(words: DataFrame, times: int = TIMES, crowd: int = CROWD) -> DataFrame:
    """Every word of (word, n) with its form, root, n_near and form_n."""
    words = cut(words)
    pairs = near_pairs(words, crowd)
    turned = pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b"))
    best = F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form")))
    near = pairs.unionByName(turned).groupBy(F.col("a").alias("word"), F.col("n_a").alias("n")).agg(F.count("*").alias("n_near"), best.alias("best"))
    commoner: Column = -F.col("best.less") >= times * F.col("n")
    near = cut(near.select("word", "n_near", F.when(commoner, F.col("best.form")).alias("form"), F.when(commoner, -F.col("best.less")).alias("form_n")))
    roots = _last(near.filter("form is not null"))
    named = words.join(near.join(roots, "word", "left"), "word", "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
