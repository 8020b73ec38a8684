"""Near duplicates of weighted shingles by ProbMinHash, banding and exact verification.

A text is the multiset of its five-word shingles (a text of fewer words is one shingle of them all); likeness is the
probability Jaccard similarity of the counts, which for texts without repeated shingles is the plain one. Every shingle
is a Poisson process whose rate is its count: its points fall into the components of the signature at random, and the
earliest point of each component wins. Points are made in rounds and a text is done when no shingle can come earlier
than the latest winner. Two texts agree in a component with the probability that is their likeness.

1. Equal texts are reduced to their smallest id before anything else (aggregated before the shuffle).
2. Bands of the signature bring texts together. The first few are dealt first: each member of a band meets the member of
   smallest id; links, verified on the texts, make classes by the smallest id that can be reached. Most of a large group
   is one class by then, and its other bands make no pairs.
3. The next round looks at all bands whose members still belong to different classes. In bands of at most ``SMALL``
   members all meet across classes; in larger ones all members meet ``LEADERS`` members drawn by hashes, others in each
   band. In larger bands both rounds only make classes fewer before the next step.
4. Members of larger bands that still hold several classes are searched in full, by prefixes: shingles of a text are
   put in one order, rare ones first, and two texts as alike as the threshold must share one of the first shingles of
   each (those before which less than the missing part of the text lies). Pairs of different classes that do, and
   whose place there leaves room for the likeness, are tested. This leaves out no pair that is alike enough.
5. Classes are made again from all links.

Pairs inside a class are never listed, so ``n_links`` counts tested links, not all near texts: the links of a text to
the texts it was tested with. In a group of texts that are all near each other it is less than the group's size, and it
depends on which leaders were drawn. Classes do not.

With 32 bands of 4, a pair of likeness 0.8 shares no band with a probability of 5e-8. Every link is verified exactly.

Null or blank text: near nothing; only equal blank texts share a class. Null text or id: a class of its own (null
``class_id`` for null ids). Ids are integers or text that reads as integers. Rows that repeat an id share its class, with
all texts under it; number the rows to have each judged by itself. Existing columns of the added names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.frames import privately, table, without
from orderlake.llm.text import grams, mix, slices, words_of

SHINGLE = 5
BANDS, ROWS = 32, 4
COMPONENTS = BANDS * ROWS
ROUNDS = (4,)  # bands dealt up to the end of each round; the rest is dealt by step 3
SMALL = 8  # members of a band of which all pairs across classes are tested at once
LEADERS = 1  # members drawn in each larger band for all others to meet
FREQUENT = 1 << 18  # shingles whose counts order the others, at most
SPREAD = 1024  # texts of a shingle that one task compares with all others of it


def weighted_shingles(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, shingle hash and count of the distinct shingles of each text, by text and hash."""
    words = words_of(column)
    owner = words.text_of_word()
    found = grams(words.hashes, size)
    whole = owner[: len(found)] == owner[size - 1 :] if len(found) else np.zeros(0, dtype=bool)
    text, shingle = owner[: len(found)][whole], found[whole]
    lengths = np.diff(words.first)
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    if len(short):
        extra = [grams(words.hashes[words.first[i] : words.first[i + 1]], int(lengths[i]), 99)[0] for i in short]
        text = np.concatenate([text, short])
        shingle = np.concatenate([shingle, np.array(extra, dtype=np.uint64)])
    order = np.lexsort((shingle, text))
    text, shingle = text[order], shingle[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(new)
    return text[at], shingle[at], np.diff(np.append(at, len(text)))


def signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, m: int = COMPONENTS) -> np.ndarray:
    """ProbMinHash of ``n`` texts: the shingle that wins each of ``m`` components; 0 where a text has none."""
    best = np.full(n * m, np.inf)
    winner = np.zeros(n * m, dtype=np.uint64)
    time = np.zeros(len(text))
    rate = weight.astype(np.float64)
    step = 0
    while len(text):
        step += 1
        draw = mix(shingle + np.uint64(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53) / rate
        cell = text * m + (mix(draw) % np.uint64(m)).astype(np.int64)
        np.minimum.at(best, cell, time)
        won = best[cell] == time
        winner[cell[won]] = shingle[won]
        open_texts = np.unique(text)
        latest = np.zeros(n)
        latest[open_texts] = best.reshape(n, m)[open_texts].max(axis=1)
        alive = time < latest[text]
        text, shingle, rate, time = text[alive], shingle[alive], rate[alive], time[alive]
    return winner.reshape(n, m)


def probability_jaccard(p: np.ndarray, q: np.ndarray) -> float:
    """Sum over x of 1 / sum over y of max(p_y / p_x, q_y / q_x), over aligned weights of two texts."""
    both = (p > 0) & (q > 0)
    if not both.any():
        return 0.0
    with np.errstate(divide="ignore"):
        ratio = np.where(p > 0, q / np.where(p > 0, p, 1), np.inf)
    order = np.argsort(ratio)
    ratio, p_sorted, q_sorted = ratio[order], p[order], q[order]
    p_below = np.cumsum(p_sorted)
    q_above = q_sorted.sum() - np.cumsum(q_sorted)
    at = np.searchsorted(ratio, q[both] / p[both], side="right") - 1
    return float((1.0 / (p_below[at] / p[both] + q_above[at] / q[both])).sum())


def similarities(left: pa.Array, right: pa.Array, size: int = SHINGLE) -> np.ndarray:
    """Exact likeness of each pair of texts."""
    n = len(left)
    (ta, sa, wa), (tb, sb, wb) = weighted_shingles(left, size), weighted_shingles(right, size)
    text, shingle = np.concatenate([ta, tb]), np.concatenate([sa, sb])
    order = np.lexsort((shingle, text))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (text[order][1:] != text[order][:-1]) | (shingle[order][1:] != shingle[order][:-1])
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    total = int(new.sum())
    p, q = np.zeros(total), np.zeros(total)
    p[place[: len(ta)]] = wa
    q[place[len(ta) :]] = wb
    owner = text[order][new]
    union = np.bincount(owner, minlength=n)
    shared = np.bincount(owner[(p > 0) & (q > 0)], minlength=n)
    out = shared / np.maximum(union, 1)
    first = np.searchsorted(owner, np.arange(n + 1))
    for i in np.unique(owner[(p > 1) | (q > 1)]):  # repeated shingles: the weights matter
        part = slice(first[i], first[i + 1])
        out[i] = probability_jaccard(p[part], q[part])
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text) to (doc, bands); texts without words give no row."""
    seed = mix(np.arange(1, BANDS + 1))
    for batch in slices(batches, "text"):
        text, shingle, weight = weighted_shingles(batch.column(1))
        won = signatures(text, shingle, weight, batch.num_rows).reshape(-1, BANDS, ROWS)
        key = np.broadcast_to(seed, won.shape[:2])
        for r in range(ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + won[:, :, r])
        some = np.unique(text)
        bands = pa.FixedSizeListArray.from_arrays(pa.array(key[some].ravel().view(np.int64)), BANDS)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(some)), bands.cast(pa.list_(pa.int64()))], ["doc", "bands"]
        )


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "left_text"):
            near = np.flatnonzero(similarities(batch.column(2), batch.column(3)) >= threshold)
            if len(near):
                at = pa.array(near)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], ["a", "b"])

    return run


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Those (a, b) pairs whose texts, of (doc, text) rows, are at least so alike."""
    left = pairs.join(texts, F.col("a") == F.col("doc")).select("a", "b", F.col("text").alias("left_text"))
    both = left.join(texts, F.col("b") == F.col("doc")).select("a", "b", "left_text", "text")
    return both.mapInArrow(_verify(threshold), "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of (a, b) links; the component is its smallest node.

    Rounds of taking the smallest label among neighbours and then that label's own label; each round is a written
    table, and the driver sees one count a round. Labels meet at a hub by a minimum that is taken before the shuffle.
    """
    links = table(edges.union(edges.select("b", "a")).distinct(), "links")
    labels = table(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                   .select("node", F.least("node", "least").alias("component")), "labels")
    while True:
        heard = (
            links.join(labels, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("component").alias("heard"))
        )
        met = labels.join(heard, F.col("node") == F.col("a")).select(
            "node", "component", F.least("component", "heard").alias("next")
        )
        jump = labels.select(F.col("node").alias("via"), F.col("component").alias("further"))
        moved = table(
            met.join(jump, F.col("next") == F.col("via"), "left").select(
                "node", F.least("next", "further").alias("component"),
                (F.least("next", "further") < F.col("component")).alias("changed"),
            ),
            "labels",
        )
        labels = moved.select("node", "component")
        if moved.where("changed").isEmpty():
            return labels


def _candidates(rows: DataFrame, first: bool) -> DataFrame:
    """Pairs (a, b) of a round, across classes, of (band, doc, label) rows."""
    drawn = [F.col("doc")] if first else [F.xxhash64("doc", "band", F.lit(i)) for i in range(LEADERS)]
    leaders = [F.min(F.struct(x.alias("drawn"), F.col("doc"), F.col("label"))) for x in drawn]
    held = (
        rows.groupBy("band")
        .agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"),
             F.array_distinct(F.transform(F.array(*leaders), lambda x: F.struct(x["doc"], x["label"]))).alias("leaders"))
        .where("low < high")
    )
    pair = (F.least("doc", "other").alias("a"), F.greatest("doc", "other").alias("b"))
    large = F.col("n") > (0 if first else SMALL)
    chosen = held.where(large).select("band", F.explode("leaders").alias("leader"))
    chosen = chosen.select("band", F.col("leader.doc").alias("other"), F.col("leader.label").alias("other_label"))
    led = rows.join(chosen, "band").where("label != other_label").select(*pair)
    if first:
        return led
    small = rows.join(held.where(~large).select("band"), "band")
    others = small.select("band", F.col("doc").alias("other"), F.col("label").alias("other_label"))
    return led.union(small.join(others, "band").where("label < other_label").select(*pair))


def _count_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        shingle, n = np.unique(weighted_shingles(batch.column(batch.schema.get_field_index("text")))[1], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(shingle.view(np.int64)), pa.array(n)], ["shingle", "n"])


def _frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of the most frequent shingles; the driver sees at most ``FREQUENT``."""
    counted = texts.select("text").mapInArrow(_count_shingles, "shingle bigint, n bigint")
    counts = table(counted.groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 1"), "shingle-counts")
    level = F.floor(F.log2("n") * 8).cast("int").alias("level")
    least, room = None, FREQUENT
    for row in sorted(counts.groupBy(level).agg(F.count("*").alias("of")).collect(), reverse=True):
        room -= row.of
        if room < 0:
            break
        least = row.level
    front = (counts.where(level >= F.lit(least)) if least is not None else counts.limit(0)).toPandas()
    shingle = front["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(shingle)
    return shingle[order], front["n"].to_numpy(np.int64)[order]


def _prefixes(threshold: float, frequent: np.ndarray, counts: np.ndarray):
    """(doc, label, text) to the first shingles of each text, with the weight from each on and the whole weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            text, shingle, weight = weighted_shingles(batch.column(2))
            rank = np.ones(len(shingle), dtype=np.int64)
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, shingle), len(frequent) - 1)
                rank = np.where(frequent[at] == shingle, counts[at], 1)
            order = np.lexsort((shingle, rank, text))
            text, shingle, weight = text[order], shingle[order], weight[order]
            total = np.bincount(text, weights=weight, minlength=batch.num_rows)
            plain = np.bincount(text, minlength=batch.num_rows) == total
            before = np.cumsum(weight) - weight
            rest = total[text] - (before - before[np.searchsorted(text, text)])
            kept = np.flatnonzero(rest >= threshold * total[text] - 1e-9)
            owner = text[kept]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shingle[kept].view(np.int64)), batch.column(0).take(pa.array(owner)),
                 batch.column(1).take(pa.array(owner)), pa.array(rest[kept]), pa.array(total[owner]), pa.array(plain[owner])],
                ["shingle", "doc", "label", "rest", "total", "plain"],
            )

    return run


def _searched(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) across classes of (doc, label) rows, among them all whose texts are at least so alike.

    Shared weight lies at or after the first shared shingle, so it is at most the smaller of the weights from there on.
    Likeness of texts without repeated shingles is shared by united number; any likeness is at most the shared part.
    """
    held = table(texts.join(members, "doc").select("doc", "label", "text"), "open-texts")
    schema = "shingle bigint, doc bigint, label bigint, rest double, total double, plain boolean"
    found = table(held.mapInArrow(_prefixes(threshold, *_frequent(held)), schema).distinct(), "prefixes")
    meet = (
        found.groupBy("shingle")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"),
             F.ceil(F.count("*") / F.lit(SPREAD)).cast("int").alias("parts"))
        .where("low < high").select("shingle", "parts")
    )
    found = found.join(meet, "shingle")
    one = found.withColumn("part", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int"))
    other = found.select(
        "shingle", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("doc").alias("other"),
        F.col("label").alias("other_label"), F.col("rest").alias("other_rest"), F.col("total").alias("other_total"),
        F.col("plain").alias("other_plain"),
    )
    room = F.when(
        F.col("plain") & F.col("other_plain"),
        F.least("rest", "other_rest") >= F.lit(threshold / (1 + threshold)) * (F.col("total") + F.col("other_total")) - 1e-9,
    ).otherwise(
        F.least(F.col("rest") / F.col("total"), F.col("other_rest") / F.col("other_total")) >= F.lit(threshold - 1e-9)
    )
    met = one.join(other, ["shingle", "part"]).where((F.col("label") < F.col("other_label")) & room)
    return met.select(F.least("doc", "other").alias("a"), F.greatest("doc", "other").alias("b")).distinct()


def _open(rows: DataFrame, links: DataFrame) -> DataFrame:
    """(band, doc, label) of those (band, doc) rows whose band is of several classes by the links; a written table."""
    labelled = rows.join(components(links), F.col("doc") == F.col("node"), "left").select(
        "band", "doc", F.coalesce("component", "doc").alias("label")
    )
    split = (
        labelled.groupBy("band")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"))
        .where("low < high")
    )
    return table(labelled.join(split.select("band", "n"), "band"), "open-bands")


def _links(bands: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Verified links of (doc, bands) rows."""
    rows = bands.select("doc", F.explode("bands").alias("band"))
    tested = links = None
    for begin, end in zip((0, *ROUNDS), ROUNDS, strict=False):
        dealt = bands.select("doc", F.explode(F.slice("bands", begin + 1, end - begin)).alias("band"))
        labelled = dealt.withColumn("label", F.col("doc")) if links is None else _open(dealt, links)
        pairs = _candidates(labelled, True).distinct()
        pairs = table(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        found = table(verified(pairs, texts, threshold), "links")
        tested, links = (pairs, found) if tested is None else (tested.union(pairs), links.union(found))
    labelled = _open(rows, links)
    across = table(_candidates(labelled, False).distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
    links = links.union(table(verified(across, texts, threshold), "links"))
    large = labelled.where(F.col("n") > SMALL)
    if large.isEmpty():
        return links
    members = table(_open(large.select("band", "doc"), links).select("doc", "label").distinct(), "open-members")
    if members.isEmpty():
        return links
    rest = _searched(members, texts, threshold).join(tested.union(across), ["a", "b"], "left_anti")
    return links.union(table(verified(table(rest, "pairs"), texts, threshold), "links"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8
) -> DataFrame:
    """``docs`` with ``class_id`` (smallest id of its class), ``copy_of`` (smallest id with the same text) and
    ``n_links`` (links of that text to others among the pairs that were tested)."""
    added = ("class_id", "copy_of", "n_links")
    base, names, name_of = privately(without(docs, added))
    key = F.col(name_of(id_col)).cast("bigint")
    source = base.select(key.alias("doc"), F.col(name_of(text_col)).alias("text")).where(
        "doc IS NOT NULL AND text IS NOT NULL"
    )
    keys = source.select("doc", F.sha2("text", 256).alias("digest"))
    first = keys.groupBy("digest").agg(F.min("doc").alias("rep"))
    members = table(keys.join(first, "digest").select("doc", "rep").distinct(), "members")
    reps = members.where("doc = rep").select(F.col("rep")).distinct()
    bands = table(
        source.mapInArrow(_sign, "doc bigint, bands array<bigint>")
        .join(reps, F.col("doc") == F.col("rep"), "left_semi"),
        "bands",
    )
    links = _links(bands, source, threshold)
    final = components(links)
    degree = (
        links.union(links.select("b", "a")).groupBy("a").agg(F.count("*").alias("n")).withColumnRenamed("a", "end")
    )
    result = (
        members.join(final, F.col("rep") == F.col("node"), "left")
        .join(degree, F.col("rep") == F.col("end"), "left")
        .groupBy(F.col("doc").alias("_doc"))
        .agg(
            F.min(F.coalesce("component", "rep")).alias("class_id"),
            F.min("rep").alias("copy_of"),
            F.sum(F.coalesce("n", F.lit(0))).alias("n_links"),
        )
    )
    joined = base.join(result, key == F.col("_doc"), "left").select(
        *names,
        F.coalesce("class_id", key).alias("class_id"),
        F.coalesce("copy_of", key).alias("copy_of"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
    return joined.toDF(*without(docs, added).columns, *added)
