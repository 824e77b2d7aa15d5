"""Exact n-gram Jaccard join by adaptive multi-match prefixes.

A document is its set of word shingles. Documents of equal sets are one class; classes link when
100 * intersection >= percent * union, and linked classes form components.

Tokens have one global order, rare ones first. Two sets of enough overlap share at least l
tokens of their l-prefixes, the first |x| - ceil(t |x|) + l tokens. A longer prefix costs longer posting lists
and asks for more shared tokens, which spares verifications: each class takes the l of least
estimated cost from the posting lists it would read, and a pair goes by the smaller of its two.

Order: a sketch of fixed size counts all tokens of all documents; it only orders tokens, so
its size bounds what is broadcast and decides nothing. A set is kept as its prefix alone.

Groups of near copies would make all their pairs. So the class that shares most, in each posting
list, is paired with the others, verified and contracted; then only pairs between different components
are candidates, and in a list they are sought for the classes outside its largest component. Every
pair of classes that share enough prefix tokens is either in one component already or verified.

A set also has a bitmap of ``BITS`` parities. Two sets differ by at least as many tokens as their bitmaps
have different bits, so a pair whose bitmaps differ too much is refused where it meets, before it makes a row.

Defined results: null and empty texts have no shingles and are linked with nothing; a text of
fewer words than a shingle is one shingle; null ids take part and are never a component's
smallest id unless there is no other; repeated rows are copies; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom.llm.common import ascii_lower, gram_hashes, id_filter, lists, may_hold, words, written
from dayloom.llm.components import components

#: Counters of the sketch that orders tokens: 2 MB.
SKETCH = 1 << 18
#: Longest extension of a prefix, and the cost of a verification in posting entries.
MOST_MATCHES, VERIFY_COST = 4, 50
#: Parities of a set's bitmap. Fewer or more change cost only: sets of a few thousand tokens fill them.
BITS = 512


def shingles(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of a text's shingles, sorted."""
    h = np.ascontiguousarray(word_hashes, dtype=np.int64).view(np.uint64)
    return np.unique(gram_hashes(h, min(size, len(h)))) if len(h) else h


def _least(n, percent: int):
    """Least overlap of a set of n with any set it links with."""
    return -(-percent * n // 100)


def _parities(tokens: np.ndarray) -> np.ndarray:
    """How often each residue of a token occurs, modulo two, as 64-bit numbers."""
    odd = np.bincount((tokens >> np.uint64(32)).astype(np.int64) % BITS, minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sign(tokens: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return tuple(np.frombuffer(digest, np.int64).tolist())


def text_place(text: Column) -> Column:
    """A 31-bit hash of a text, which tells rows of one id apart."""
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(1 << 31))


def id_key(doc_id: Column) -> Column:
    """An id as a key that joins: a null becomes the least long."""
    return F.coalesce(doc_id.cast("long"), F.lit(-(1 << 63)))


def _hashed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.transform(words(ascii_lower(F.col(text))), lambda w: F.xxhash64(w)).alias("h"),
        text_place(F.col(text)).alias("place"),
    )


def _sketch(docs: DataFrame, size: int, doc_id: str, text: str):
    """Counts of all tokens, hashed to a fixed number of counters; a broadcast array."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(SKETCH, np.int64)
        for frame in frames:
            for h in frame["h"]:
                np.add.at(counts, (shingles(h, size) & np.uint64(SKETCH - 1)).astype(np.int64), 1)
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"at": at, "n": counts[at]})

    sums = _hashed(docs, doc_id, text).select("h").mapInPandas(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    full = np.zeros(SKETCH, np.int64)
    full[sums["at"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return docs.sparkSession.sparkContext.broadcast(full)


def _rare_part(counts: np.ndarray) -> tuple[int, int, int]:
    """Of a prefix's counts in order: how many are at most half of the last, a bound above these, the last."""
    if not len(counts):
        return 0, 0, 0
    rare = int((2 * counts <= counts[-1]).sum())
    return rare, int(counts[rare - 1]) + 1 if rare else 0, int(counts[-1])


def signatures(docs: DataFrame, size: int, percent: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, place, the set's 128-bit signature (s1, s2), its size n, its longest prefix and its bitmap."""
    order = _sketch(docs, size, doc_id, text)

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = order.value
        for frame in frames:
            rows = []
            for h in frame["h"]:
                tokens = shingles(h, size)
                n = len(tokens)
                least = int(_least(n, percent))
                ranked = np.lexsort((tokens, counts[(tokens & np.uint64(SKETCH - 1)).astype(np.int64)]))
                prefix = tokens[ranked[: n - least + min(MOST_MATCHES, least)]]
                rows.append((*_sign(tokens), n, *_rare_part(counts[(prefix & np.uint64(SKETCH - 1)).astype(np.int64)]), prefix.view(np.int64),
                             _parities(tokens)))
            s1, s2, n, rare, below, last, prefix, bits = zip(*rows) if rows else ((),) * 8
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64").array, "place": frame["place"].to_numpy(), "s1": np.array(s1, np.int64),
                                "s2": np.array(s2, np.int64), "n": np.array(n, np.int64), "rare": np.array(rare, np.int64),
                                "below": np.array(below, np.int64), "last": np.array(last, np.int64), "prefix": lists(prefix), "bits": lists(bits)})

    return _hashed(docs, doc_id, text).mapInPandas(
        sign, "doc_id long, place long, s1 long, s2 long, n long, rare long, below long, last long, prefix array<long>, bits array<long>")


def _cid(salt: int) -> Column:
    return F.xxhash64("s1", "s2", F.lit(salt))


def _classes(signed: DataFrame) -> tuple[DataFrame, int]:
    """One row per distinct set: cid, its signature, n, prefix and the smallest id and place.

    A class is numbered by a hash of its signature; also returned is the salt of that hash.
    """
    rows = signed.where("n > 0").groupBy("s1", "s2").agg(
        F.min("doc_id").alias("min_id"), F.min(F.struct("doc_id", "place")).alias("_row"),
        *(F.first(c).alias(c) for c in ("n", "rare", "below", "last", "prefix", "bits")),
    )
    salt = 0
    while True:
        classes = written(rows.withColumn("cid", _cid(salt)), "classes")
        # Numbers must be distinct, however unlikely it is that they are not.
        if classes.select("cid").groupBy("cid").count().where("count > 1").isEmpty():
            return classes, salt
        salt += 1


def _matches(classes: DataFrame, percent: int) -> DataFrame:
    """Posting entries of tokens that two or more classes share: token, cid, n, level, rare, length.

    ``level`` is the least l whose prefix holds the token; ``rare`` tells whether it is in the
    prefix's rare part.
    """
    entries = classes.select("cid", "n", F.col("rare").alias("_rare"), F.posexplode("prefix").alias("_at", "token"))
    base = F.col("n") - F.expr(f"({percent} * n + 99) div 100")
    entries = entries.select("token", "cid", "n", F.greatest(F.lit(1), F.col("_at") + 1 - base).cast("int").alias("level"), (F.col("_at") < F.col("_rare")).alias("rare"))
    length = F.count("*").over(Window.partitionBy("token"))
    return written(entries.withColumn("length", length).where("length > 1"), "postings")


def _choose(postings: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """cid, ell (how many shared tokens a class asks for, by the least estimated cost), weight, own, below, last.

    Reading the lists of an l-prefix costs their entries; of the classes met there at most one
    in l of the entries can meet l times, and each of these costs a verification. ``weight``
    is what the class shares with others in all: the text that a group was copied from has most.
    ``own`` counts the tokens of its rare part that no other prefix holds. They come before
    whatever is counted ``below`` or more, so a class whose prefix ends there lacks them all.
    """
    met = [F.sum(F.when(F.col("level") <= m, F.col("length") - 1).otherwise(0)).alias(f"c{m}") for m in range(1, MOST_MATCHES + 1)]
    shared = F.sum(F.col("rare").cast("int")).alias("_shared")
    sums = postings.groupBy("cid").agg(F.first("n").alias("n"), shared, *met).join(
        classes.select("cid", F.col("rare").alias("_rare"), "below", "last"), "cid")
    most = F.least(F.lit(MOST_MATCHES), F.expr(f"({percent} * n + 99) div 100"))
    costs = [
        F.when(F.lit(m) <= most, F.struct((F.col(f"c{m}") * (1 + VERIFY_COST / m**2)).alias("cost"), F.lit(m).alias("ell")))
        for m in range(1, MOST_MATCHES + 1)
    ]
    return sums.select("cid", F.least(*costs)["ell"].alias("ell"), F.col(f"c{MOST_MATCHES}").alias("weight"),
                       (F.col("_rare") - F.col("_shared")).alias("own"), "below", "last")


def _stars(postings: DataFrame) -> DataFrame:
    """Pairs (a, b) of a list's weightiest class with the others, where most of a prefix agrees."""
    first = Window.partitionBy("token").orderBy(F.desc("weight"), "cid")
    led = postings.select("cid", "n", F.first("cid").over(first).alias("a"), F.first("n").over(first).alias("na"))
    pairs = led.where("a != cid").groupBy("a", F.col("cid").alias("b")).agg(
        F.count("*").alias("shared"), F.first("n").alias("n"), F.first("na").alias("na"))
    return pairs.where("20 * shared >= least(n, na)").select("a", "b")


def _met(postings: DataFrame, classes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """A row (x, y) for each token that two classes of different components share and that may count for a link."""
    known = postings.join(labels.withColumnRenamed("node", "cid"), "cid", "left").select(
        "token", "cid", "n", "level", "ell", "own", "below", "last", F.coalesce("component", "cid").alias("comp"))
    known = known.where("level <= ell")
    own = F.count("*").over(Window.partitionBy("token", "comp"))
    largest = F.max(F.struct("_own", "comp")).over(Window.partitionBy("token"))
    mixed = known.withColumn("_own", own).withColumn("_top", largest["comp"]).withColumn(
        "_several", F.min("comp").over(Window.partitionBy("token")) != F.max("comp").over(Window.partitionBy("token")))
    mixed = mixed.where("_several").select("token", "cid", "n", "level", "ell", "own", "below", "last", "comp", (F.col("comp") != F.col("_top")).alias("rest"))
    mixed = written(mixed.join(classes.select("cid", "bits"), "cid"), "mixed")
    overlap = f"(({percent} * (x.n + y.n) + {99 + percent}) div {100 + percent})"
    x, y = mixed.where("rest").alias("x"), mixed.alias("y")
    apart = " + ".join(f"bit_count(x.bits[{i}] ^ y.bits[{i}])" for i in range(BITS // 64))
    return x.join(y, F.col("x.token") == F.col("y.token")).where(
        "x.comp != y.comp and (not y.rest or x.cid < y.cid) and greatest(x.level, y.level) <= least(x.ell, y.ell)"
    ).where(f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)").where(
        # Tokens of one's own are not shared: what is left must reach the least overlap.
        f"not (x.below <= y.last and x.n - x.own < {overlap}) and not (y.below <= x.last and y.n - y.own < {overlap})"
    ).where(f"x.n + y.n - ({apart}) >= 2 * {overlap}")


def _candidates(postings: DataFrame, classes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different components that share enough tokens of their prefixes."""
    met = _met(postings, classes, labels, percent)
    pairs = met.groupBy(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).agg(
        F.count("*").alias("shared"), F.first(F.least("x.ell", "y.ell")).alias("ell"),
        F.first(F.col("x.n") + F.col("y.n")).alias("both"), F.first(F.greatest("x.n", "y.n")).alias("n"),
    )
    # Tokens beyond the prefixes add at most ceil(t n) - l to what is shared within them.
    need = f"({percent} * both + {99 + percent}) div {100 + percent}"
    return pairs.where(f"shared >= ell and shared >= {need} - ({percent} * n + 99) div 100 + ell").select("a", "b")


def _verified(docs: DataFrame, classes: DataFrame, salt: int, pairs: DataFrame, size: int, percent: int, doc_id: str,
              text: str) -> DataFrame:
    """The pairs (a, b) that link. Whole sets are made again from the texts, for these classes only.

    Sets are shuffled once, by class, and pairs come to them; both sides of a pair use the
    same exchange.
    """
    pairs = written(pairs, "pairs")
    nodes = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
    bitmap = id_filter(nodes.join(classes, "cid").select(F.col("_row.place").alias("place")), "place")

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            hit = frame[may_hold(bitmap.value, frame["place"].to_numpy(np.int64))]
            found = [shingles(h, size) for h in hit["h"]]
            signs = np.array([_sign(t) for t in found], np.int64).reshape(-1, 2)
            yield pd.DataFrame({"s1": signs[:, 0], "s2": signs[:, 1], "tokens": lists([t.view(np.int64) for t in found])})

    texts = _hashed(docs, doc_id, text).select("h", "place").mapInPandas(sets, "s1 long, s2 long, tokens array<long>")
    full = texts.groupBy(_cid(salt).alias("cid")).agg(F.min("tokens").alias("tokens"))
    with_a = pairs.hint("merge").join(full.select(F.col("cid").alias("a"), F.col("tokens").alias("ta")), "a")
    with_both = with_a.hint("merge").join(full.select(F.col("cid").alias("b"), F.col("tokens").alias("tb")), "b")

    def agree(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            shared = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(frame["ta"], frame["tb"])], np.int64)
            union = frame["ta"].map(len).to_numpy(np.int64) + frame["tb"].map(len).to_numpy(np.int64) - shared
            yield frame.loc[100 * shared >= percent * union, ["a", "b"]]

    return with_both.mapInPandas(agree, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, place, n_shingles, class_id and component_id of every row of ``docs``.

    ``place`` is a 31-bit hash of the text, which tells rows of one id apart; ``first_row`` is
    true for the rows of the component's first (doc_id, place), nulls first.
    """
    signed = written(signatures(docs, size, percent, doc_id, text), "signatures")
    classes, salt = _classes(signed)
    postings = _matches(classes, percent)
    postings = written(postings.join(_choose(postings, classes, percent), "cid"), "chosen")
    stars = written(_verified(docs, classes, salt, _stars(postings), size, percent, doc_id, text), "stars")
    pairs = _candidates(postings, classes, written(components(stars), "labels"), percent)
    links = stars.unionByName(_verified(docs, classes, salt, pairs, size, percent, doc_id, text))
    labels = written(components(links), "labels")
    named = classes.join(labels.withColumnRenamed("node", "cid"), "cid", "left").select(
        "s1", "s2", "cid", "min_id", "_row", F.coalesce("component", "cid").alias("comp"))
    per_component = named.groupBy("comp").agg(F.min("min_id").alias("component_id"), F.min("_row").alias("_first"))
    told = named.join(per_component, "comp").select("s1", "s2", F.col("cid").alias("class_id"), "component_id", "_first")
    rows = signed.select("doc_id", "place", "s1", "s2", F.col("n").alias("n_shingles")).join(told, ["s1", "s2"], "left")
    first = F.struct("doc_id", "place").eqNullSafe(F.col("_first"))
    return rows.select(
        "doc_id", "place", "n_shingles", "class_id",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        ((F.col("n_shingles") == 0) | first).alias("first_row"),
    )
