"""Near duplicates by one-permutation MinHash, banded buckets and star edges.

1. One pass over the texts gives each document the size and a 128-bit digest of its
   shingle set, and one key per band from a one-permutation signature whose empty
   bins are filled by optimal densification.
2. Equal sets become one class first, so buckets hold different sets only, and a
   class of copies is one row however large it is.
3. In every bucket the member that meets most others in all its buckets is the hub, and
   star edges go from it to the other members.  They are confirmed on the full shingle
   sets, in groups of one hub and some members, so a popular hub is shared by many tasks.
4. A bucket whose members now are in one component is done, which settles nearly all,
   and large groups of near copies first.  Buckets that are too large for one block get
   further stars, from members of their largest component to those outside.  Then the rest is
   settled in blocks of bounded size: an inverted index of the full sets compares the
   members outside a bucket's largest component with all its members, and only links
   that join two components come out.

So every two different sets that share a bucket are either compared on their full sets
or already connected.  Nothing is capped or sampled, and no list of pairs is made.

Defined cases: a null or empty text, or one without words, has an empty set and is
linked with nothing.  Rows with equal sets are linked whatever their ids; rows that
share a doc_id are one document, linked by any of its texts.  A row without doc_id
takes the component of its set.  An empty table gives an empty result.  Extra columns
are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import text as tx
from rollbook.llm.components import components, save
from rollbook.session import workspace

BANDS = 36
ROWS = 6  # signature values in a band
SIMILARITY = 80  # percent
GROUP = 64  # members confirmed against one copy of their hub's set
BLOCK = 2_000_000  # shingles of a bucket that one task compares at a time
TURNS = 5  # of further stars in larger buckets, at most
SHINGLE_WORDS = 5


@cache
def probes(bins: int) -> np.ndarray:
    """For every bin, the turn at which densification would look into each bin.

    Probing by a hash until a full bin is met visits the bins in a random order of the
    bin's own; this is that order, without the repeated visits.
    """
    order = np.argsort(tx.mix(tx.constants(11, bins * bins)).reshape(bins, bins), axis=1)
    turn = np.empty((bins, bins), np.int32)
    np.put_along_axis(turn, order, np.arange(bins, dtype=np.int32)[None, :], axis=1)
    return turn


def signatures(values: np.ndarray, row: np.ndarray, n_rows: int, bins: int) -> np.ndarray:
    """One-permutation signature of each row's set: the least hash in each bin, and in
    an empty bin that of the first full bin among its probes.

    ``values`` are distinct hashes ordered by row and value, so a bin (their high bits)
    begins where its least hash is.
    """
    where = ((values >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    cell = row * bins + where.astype(np.int64)
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    least = np.zeros(n_rows * bins, np.uint64)
    least[cell[first]] = values[first]
    full = np.zeros(n_rows * bins, bool)
    full[cell[first]] = True
    least, full = least.reshape(n_rows, bins), full.reshape(n_rows, bins)
    turn = probes(bins)
    n_full = full.sum(axis=1)
    for i in np.flatnonzero((n_full > 0) & (n_full < bins)):
        have, miss = np.flatnonzero(full[i]), np.flatnonzero(~full[i])
        donor = have[turn[miss[:, None], have[None, :]].argmin(axis=1)]
        least[i, miss] = least[i, donor]
    return least


def band_keys(least: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key for each row and band."""
    n, bins = least.shape
    rows = bins // bands
    total = (tx.mix(least).reshape(n, bands, rows) * tx.constants(13, rows)).sum(axis=2, dtype=np.uint64)
    return tx.mix(total + tx.constants(17, bands))


def word_shingles(texts: tx.Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row): the distinct k-word shingles of each text, A-Z lower-cased."""
    spans = tx.words(texts)
    found, row = tx.shingles(tx.hashes(texts.data, spans, tx.LOWER), spans.row, len(texts), k)
    return tx.distinct(found, row)


def sketch(docs: DataFrame, words: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, text_hash, n_shingles, digest (d1, d2) and band keys of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in tx.pieces(batch):
                n = len(texts)
                found, row = word_shingles(texts, words)
                keys = band_keys(signatures(found, row, n, bands * rows), bands)
                size = np.bincount(row, minlength=n).astype(np.int64)
                taken = np.where(size > 0, bands, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_hash"),
                        pa.array(size),
                        tx.signed(tx.sum_by_row(tx.mix(found ^ np.uint64(0xA5)), row, n)),
                        tx.signed(tx.sum_by_row(tx.mix(found ^ np.uint64(0x5A)), row, n)),
                        pa.ListArray.from_arrays(
                            np.concatenate([[0], np.cumsum(taken)]).astype(np.int32),
                            tx.signed(keys[size > 0].ravel()),
                        ),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "d1", "d2", "keys"],
                )

    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")
    )
    return named.mapInArrow(
        run, "doc_id long, text_hash long, n_shingles long, d1 long, d2 long, keys array<long>"
    )


def confirm(edges: DataFrame, texts: DataFrame, words: int, similarity: int, folder: str) -> DataFrame:
    """The edges (hub, member) whose full shingle sets are similar enough.

    A hub's text goes once to each group of about GROUP members, so neither a hub with
    many members nor a long text is copied to every edge or gathered in one task.
    """
    per_hub = save(
        edges.groupBy("hub").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("groups")),
        f"{folder}/groups",
    )
    dealt = edges.join(per_hub, "hub").select(
        "hub", F.pmod(F.xxhash64("member"), "groups").cast("int").alias("part"), "member"
    )
    hubs = dealt.select("hub", "part").distinct()
    wanted = dealt.select("hub", "part", F.col("member").alias("node"), F.lit(1).alias("role")).union(
        hubs.select("hub", "part", F.col("hub").alias("node"), F.lit(0).alias("role"))
    )
    grouped = (
        wanted.join(texts, "node")
        .repartition("hub", "part")
        .sortWithinPartitions("hub", "part", "role")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own = None, []  # own: the hub's set, once for each of its texts
        for batch in batches:
            for rows, found_texts in tx.pieces(batch):
                found, row = word_shingles(found_texts, words)
                bound = np.searchsorted(row, np.arange(len(found_texts) + 1))
                keys = zip(rows.column("hub").to_pylist(), rows.column("part").to_pylist())
                kept = np.zeros(len(found_texts), bool)
                for i, (key, role) in enumerate(zip(keys, rows.column("role").to_pylist())):
                    if key != group:
                        group, own = key, []
                    mine = found[bound[i] : bound[i + 1]]
                    if role == 0:
                        own.append(mine.copy())
                    else:
                        kept[i] = any(similar(mine, other, similarity) for other in own)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(c).filter(pa.array(kept)) for c in ("hub", "node")], names=["a", "b"]
                )

    return grouped.mapInArrow(run, "a long, b long")


def similar(one: np.ndarray, other: np.ndarray, similarity: int) -> bool:
    """Are these sets (sorted arrays) alike by at least ``similarity`` percent?  An empty
    set, such as of a null text among those of a doc_id, is like none."""
    if not len(one) or not len(other):
        return False
    place = np.searchsorted(other, one)
    both = int((other[np.minimum(place, len(other) - 1)] == one).sum())
    return 100 * both >= similarity * (len(one) + len(other) - both)


def star_edges(members: DataFrame, similarity: int, folder: str) -> DataFrame:
    """(hub, member) of every bucket whose sizes allow the similarity."""
    sizes = save(members.groupBy("key").agg(F.count("*").alias("members")), f"{folder}/sizes")
    met = save(
        members.join(sizes, "key").groupBy("node").agg(F.sum("members").alias("met")), f"{folder}/met"
    )
    ranked = save(members.join(met, "node").select("key", "node", "n", "met"), f"{folder}/ranked")
    hubs = save(
        ranked.groupBy("key").agg(F.max(F.struct("met", "node", "n")).alias("hub"))
        .select("key", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n")),
        f"{folder}/hubs",
    )
    fits = F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * similarity
    return (
        ranked.join(hubs, "key").filter((F.col("node") != F.col("hub")) & fits)
        .select("hub", F.col("node").alias("member"))
        .distinct()
    )


def in_components(members: DataFrame, labels: DataFrame, turn: int, folder: str) -> DataFrame:
    """Members of the buckets that hold several components: (key, node, n, label), and of
    the bucket the shingles of all members (total) and of those outside the component with most
    members (outside), that component (main), and a member of it, another in each turn (hub,
    hub_n)."""
    labelled = save(
        members.join(labels, "node", "left").select(
            "key", "node", "n", F.coalesce("label", "node").alias("label")
        ),
        f"{folder}/labelled",
    )
    parts = labelled.groupBy("key", "label").agg(
        F.count("*").alias("c"), F.sum("n").alias("s"),
        F.min_by(F.struct("node", "n"), F.struct(F.xxhash64("node", F.lit(turn)), "node")).alias("hub"),
    )
    buckets = parts.groupBy("key").agg(
        F.max(F.struct("c", "label", "s", "hub")).alias("main"), F.sum("s").alias("total"),
        F.count("*").alias("components"),
    )
    unsettled = save(
        buckets.filter("components > 1").select(
            "key", "total", (F.col("total") - F.col("main.s")).alias("outside"), F.col("main.label").alias("main"),
            F.col("main.hub.node").alias("hub"), F.col("main.hub.n").alias("hub_n"),
        ),
        f"{folder}/unsettled",
    )
    return save(labelled.join(unsettled, "key"), f"{folder}/held")


def more_stars(spark: SparkSession, members: DataFrame, links: DataFrame, texts: DataFrame, words: int,
               similarity: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """The links with those of further stars in buckets too large for one block, and the members
    of buckets that are not settled then.

    In each turn the members outside the largest component of such a bucket are compared with one
    member of it, another in every turn and bucket.  A family of texts about as alike as asked
    so comes together in a few turns, each of which moves an outside member once per bucket.
    The turns end when they no longer halve the members outside.
    """
    turn, before = 0, None
    while True:
        labels = components(spark, links, f"{folder}/components-{turn}")
        held = in_components(members, labels, turn, f"{folder}/turn-{turn}")
        large = held.filter(F.col("total") > BLOCK)
        if turn == TURNS or large.isEmpty():
            return links, held
        fits = F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * similarity
        edges = save(
            large.filter((F.col("label") != F.col("main")) & fits).select("hub", F.col("node").alias("member")).distinct(),
            f"{folder}/edges-{turn}",
        )
        outside = edges.count()
        if outside == 0 or (before is not None and 2 * outside > before):
            return links, held
        before = outside
        found = confirm(edges, texts, words, similarity, f"{folder}/confirm-{turn}")
        links = save(links.union(found), f"{folder}/links-{turn}")
        turn += 1


BASE, PROBE, BOTH = 0, 1, 2  # what a member is to the others of its group


def settle(held: DataFrame, texts: DataFrame, words: int, similarity: int, folder: str) -> DataFrame:
    """Links (a, b) between the components that still meet in a bucket.

    A bucket of one block is one group.  In a larger one only the members outside its largest
    component are compared with all: each block of those with each block of the bucket.
    """
    blocks = F.ceil(F.col("total") / BLOCK).cast("int")
    probes = F.ceil(F.col("outside") / BLOCK).cast("int")
    outside = F.col("label") != F.col("main")
    held = held.withColumn("blocks", blocks).withColumn("probes", probes)
    single = held.filter("blocks = 1").select(
        "key", F.lit(0).alias("one"), F.lit(0).alias("two"), "node", "label",
        F.when(outside, BOTH).otherwise(BASE).alias("role"),
    )
    place = F.xxhash64("node", "key")
    base = held.filter("blocks > 1").select(
        "key", F.explode(F.sequence(F.lit(0), F.col("probes") - 1)).alias("one"),
        F.pmod(place, "blocks").cast("int").alias("two"), "node", "label", F.lit(BASE).alias("role"),
    )
    probe = held.filter((F.col("blocks") > 1) & outside).select(
        "key", F.pmod(place, "probes").cast("int").alias("one"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("two"), "node", "label", F.lit(PROBE).alias("role"),
    )
    dealt = save(single.unionByName(base).unionByName(probe), f"{folder}/dealt")
    grouped = (
        dealt.join(texts, "node").repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, nodes, label, role, sets = None, [], [], [], []

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())} if len(set(label)) < 2 else
                dict(zip("ab", joins(nodes, label, role, sets, similarity)))
            )

        for batch in batches:
            for rows, found_texts in tx.pieces(batch):
                found, row = word_shingles(found_texts, words)
                bound = np.searchsorted(row, np.arange(len(found_texts) + 1))
                columns = [rows.column(c).to_pylist() for c in ("key", "one", "two", "node", "label", "role")]
                for i, (*here, node, own, part) in enumerate(zip(*columns)):
                    if here != group:
                        yield done()
                        group, nodes, label, role, sets = here, [], [], [], []
                    nodes.append(node)
                    label.append(own)
                    role.append(part)
                    sets.append(found[bound[i] : bound[i + 1]].copy())
        yield done()

    return grouped.mapInArrow(run, "a long, b long")


def joins(nodes: list[int], labels: list[int], roles: list[int], sets: list[np.ndarray], similarity: int) -> tuple:
    """Links of a group's probes with its base that connect components, as two arrays of nodes."""
    size = np.array([len(s) for s in sets])
    role = np.array(roles)
    value, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    distinct, place = np.unique(value, return_inverse=True)
    based = role[owner] != PROBE
    many = np.bincount(place[based], minlength=len(distinct))
    posting = owner[based][np.argsort(place[based], kind="stable")]  # base members by shingle
    first = np.cumsum(many) - many
    bound = np.concatenate([[0], np.cumsum(size)])
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            x = parent[x] = parent[parent[x]]
        return x

    a, b = [], []
    for x in np.flatnonzero(role != BASE):
        slot = place[bound[x] : bound[x + 1]]
        length = many[slot]
        step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        both = np.bincount(posting[np.repeat(first[slot], length) + step], minlength=len(sets))
        alike = 100 * both >= similarity * (size[x] + size - both)
        for y in np.flatnonzero(alike & (both > 0)):
            one, two = root(labels[x]), root(labels[y])
            if one != two:
                parent[two] = one
                a.append(nodes[x])
                b.append(nodes[y])
    return pa.array(a, pa.int64()), pa.array(b, pa.int64())


def verdicts(spark: SparkSession, docs: DataFrame, words: int = SHINGLE_WORDS,
             similarity: int = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept: a row for every document.

    Two sets of exactly the least similarity share none of the 36 bands with a chance
    of 2 in 100,000; any pair that shares one is found.
    """
    folder = workspace(spark, "near-dups")
    sketched = save(sketch(docs, words, bands, rows), f"{folder}/sketches")
    filled = sketched.filter("n_shingles > 0")
    # Equal sets have equal keys, so any row may stand for its class.
    classes = save(
        filled.groupBy("d1", "d2").agg(
            F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys")
        ).filter("node IS NOT NULL"),
        f"{folder}/classes",
    )
    banded = classes.select("node", "n", F.explode("keys").alias("key"))
    shared = save(
        banded.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1").select("key"),
        f"{folder}/shared",
    )
    members = save(banded.join(shared, "key"), f"{folder}/buckets")
    # Only texts whose set meets another one in some bucket are read again later.
    texts = save(
        docs.select(F.col("doc_id").cast("long").alias("node"), "text")
        .join(members.select("node").distinct(), "node"),
        f"{folder}/texts",
    )
    # A doc_id that stands at several texts ties their classes together.
    several = filled.groupBy("doc_id").agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
    links = save(
        filled.join(several, "doc_id").join(classes, ["d1", "d2"])
        .select(F.col("doc_id").alias("a"), F.col("node").alias("b")).filter("a <> b").distinct(),
        f"{folder}/links",
    )
    edges = save(star_edges(members, similarity, f"{folder}/star"), f"{folder}/edges")
    found = confirm(edges, texts, words, similarity, f"{folder}/star")
    links = save(links.union(found), f"{folder}/star-links")
    links, held = more_stars(spark, members, links, texts, words, similarity, f"{folder}/more-stars")
    more = save(settle(held, texts, words, similarity, f"{folder}/settle"), f"{folder}/more-links")
    labels = components(spark, links.union(more), f"{folder}/all-components")
    of_class = classes.select("d1", "d2", "node").join(labels, "node", "left").select(
        "d1", "d2", F.coalesce("label", "node").alias("label")
    )
    out = sketched.drop("keys").join(of_class, ["d1", "d2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("label")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    )


def keep_one(spark: SparkSession, docs: DataFrame, words: int = SHINGLE_WORDS,
             similarity: int = SIMILARITY) -> DataFrame:
    """The documents without later near copies: the smallest doc_id of each component.

    Repeated rows of a doc_id that stays all stay.  Columns are those of ``docs``.
    """
    stay = verdicts(spark, docs, words, similarity).filter("kept").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")
    ).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    return docs.join(stay, same, "left_semi")
