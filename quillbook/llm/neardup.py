"""Near-duplicate documents by an inverted join over MinHash signatures.

Every text is a set of shingles of n words; its signature has one minimum per
permutation, and a coordinate is GROUP minima together. A document is posted
under each (coordinate, value) pair. Two documents with a similarity of 0.8
agree in at least MATCHES of COORDINATES coordinates (a pair at the threshold
misses that once in a million), while texts that share some common
shingles hardly ever agree in one, so lists stay short as the corpus grows:

* texts with equal words are one node from the start, whatever their number;
* postings that only one node has cannot collide, and a node with fewer than
  MATCHES others is dropped (repeated, as each drop makes more such postings);
* prefix: of a node with c postings left only the c - MATCHES + 1 rarest are
  merged, since two nodes that share MATCHES have one of those in common.
  The most frequent values, as a passage in many texts makes them, are skipped;
* the agreement of a pair that met is counted on the whole signatures: at
  least FINE_MATCHES of FINE minima, of which one byte each is kept.

Pairs above the threshold are confirmed on the full shingle sets of the texts.
No list is turned into all its pairs while that can be avoided: each node of a
list meets one hub of the list, confirmed links join nodes to components, and
lists inside one component are done. In the first round the hubs of all lists
go by one order, so a group has few; in the later ones each list has its own,
and a node tries one hub of each other component, the one that it shares most
lists with. So every round forms pairs in proportion to the nodes. There are
HUB_ROUNDS rounds at most, fewer where one finds no link. What they leave in different components is compared pair
by pair, inside the join and each pair at its first common list: nodes that
agree with one of another component stay; sets of at most EXACT shingles are
compared themselves, so that only links come out. Pairs of larger ones may
differ in at most BITS_APART of BITS one-bit coordinates, which are made for
these nodes alone; of these pairs the closest one of each two components is
confirmed first, then those that still lie in two components.

Every table is removed as soon as what is made of it has been written.

Null, empty and blank texts have no set and link with nothing, and so do rows
without an id (component null, kept). A text with fewer words than a shingle
is one shingle. Rows that repeat an id and its text share a component; other
texts of an id are judged by themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillbook.llm.batches import MIX1, chunks, hashes, lowered, mixed, spans, utf8
from quillbook.session import discard, materialise

#: Minima of a coordinate, coordinates, and how many of them a pair must share.
GROUP, COORDINATES, MATCHES, PERCENT = 4, 32, 2, 80
FINE, FINE_MATCHES = 128, 81
#: Coordinates of which one bit is kept, and bits in which a pair at the threshold may differ (409.6 in the mean).
BITS, BITS_APART = 4096, 501
HUB_ROUNDS, PEELS = 3, 2
#: Shingles of the sets that are compared as such in the last step; larger ones are by their bits first.
EXACT = 256
SEEDS = np.random.default_rng(20240607).integers(1, 1 << 32, size=(2, FINE + BITS), dtype=np.uint32)


def _shingles(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Distinct shingle hashes of all rows in order of rows, where each row's start, and a digest of each row's words."""
    data, offsets = utf8(batch.column("text"))
    data = lowered(data)
    part = ~((data == 32) | ((data >= 9) & (data <= 13)))
    starts, ends, row = spans(part, offsets)
    words = hashes(data, starts, ends)
    rows = len(offsets) - 1
    first = np.searchsorted(row, np.arange(rows + 1))
    digests = [hashlib.blake2b(words[first[i] : first[i + 1]].tobytes(), digest_size=16).digest() for i in range(rows)]
    n = len(words)
    value = np.zeros(n, np.uint64)
    for j in range(min(size, n)):  # no shingle starts at j words or fewer before the end
        value[: n - j] = mixed(value[: n - j] * MIX1 + words[j:] + np.uint64(j + 1)) if j else mixed(words + np.uint64(1))
    count = np.diff(first)
    whole = np.zeros(n, bool)
    left = first[row + 1] - np.arange(n)  # words from here to the end of the row
    whole[left >= size] = True
    short = np.flatnonzero((count > 0) & (count < size))
    for i in short:  # fewer words than a shingle: all of them are one
        value[first[i]] = mixed(np.array([int.from_bytes(digests[i][:8], "little")], np.uint64))[0]
        whole[first[i]] = True
    value, row = value[whole], row[whole]
    bounds = np.searchsorted(row, np.arange(rows + 1))
    distinct = [np.unique(value[bounds[i] : bounds[i + 1]]) for i in range(rows)]
    sizes = np.fromiter(map(len, distinct), np.int64, rows)
    return (np.concatenate(distinct) if rows else value), np.concatenate([[0], np.cumsum(sizes)]), digests


def _minima(values: np.ndarray, starts: np.ndarray, coordinates: range) -> Iterator[np.ndarray]:
    """The least value of each set in each coordinate: a permutation of 32-bit numbers."""
    h = (values >> np.uint64(32)).astype(np.uint32)
    for c in coordinates:
        yield np.minimum.reduceat(h * (SEEDS[0, c] | np.uint32(1)) + SEEDS[1, c], starts)


def _signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows with a set: the minimum of each of FINE coordinates."""
    filled = np.flatnonzero(np.diff(bounds))
    out = np.empty((len(filled), FINE), np.int32)
    for c, least in enumerate(_minima(values, bounds[filled], range(FINE))):
        out[:, c] = least.view(np.int32)
    return out


def _coordinates(table: np.ndarray) -> np.ndarray:
    """32 bits of each GROUP minima of the signatures (rows, FINE)."""
    parts = table.view(np.uint32).astype(np.uint64).reshape(len(table), COORDINATES, GROUP)
    value = np.zeros((len(table), COORDINATES), np.uint64)
    for j in range(GROUP):
        value = mixed(value * MIX1 + parts[:, :, j] + np.uint64(j + 1))
    return (value >> np.uint64(32)).astype(np.uint32).view(np.int32)


def signed(df: DataFrame, size: int) -> DataFrame:
    """``doc_id, t, n_shingles, words, sig, fine`` of every row; equal words have an equal digest.

    ``sig`` has the coordinates that are posted, ``fine`` a byte of each minimum.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            values, bounds, digests = _shingles(batch, size)
            n = np.diff(bounds)
            table = _signatures(values, bounds) if len(values) else np.zeros((0, FINE), np.int32)
            ends = np.concatenate([[0], np.cumsum((n > 0) * COORDINATES)]).astype(np.int32)
            sig = pa.ListArray.from_arrays(pa.array(ends), pa.array(_coordinates(table).ravel()))
            ends = np.concatenate([[0], np.cumsum((n > 0) * (FINE // 8))]).astype(np.int32)
            fine = pa.ListArray.from_arrays(pa.array(ends), pa.array((table & 255).astype(np.uint8).view(np.int64).ravel()))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("t"), pa.array(n), pa.array(digests, pa.binary()), sig, fine],
                ["doc_id", "t", "n_shingles", "words", "sig", "fine"])

    rows = df.withColumn("t", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, t long, n_shingles long, words binary, sig array<int>, fine array<long>")


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return _shingles(pa.record_batch([column], ["text"]), size)[:2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "x"):
            (x, i), (y, j) = sets(batch.column("x")), sets(batch.column("y"))
            holds = []
            for k in range(batch.num_rows):
                a, b = x[i[k] : i[k + 1]], y[j[k] : j[k + 1]]
                both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
                holds.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.record_batch([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(holds, pa.bool_()))

    side = lambda n, c: texts.select(F.col("node").alias(n), F.col("text").alias(c))
    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(
        run, "a long, b long")


def _sketches(texts: DataFrame, size: int, exact: int) -> DataFrame:
    """``node, members, bits``: the set itself where it is small, and where it is large (or nearly)
    one bit of the minimum of each of BITS further coordinates, as 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            values, bounds, _ = _shingles(batch, size)
            n = np.diff(bounds)
            large = np.flatnonzero(100 * n > PERCENT * exact)
            out = np.zeros((len(large), BITS // 64), np.uint64)
            if len(large):
                own = np.concatenate([values[bounds[i] : bounds[i + 1]] for i in large])
                starts = np.cumsum(n[large]) - n[large]
                for c, least in enumerate(_minima(own, starts, range(FINE, FINE + BITS))):
                    out[:, c // 64] |= ((least >> np.uint32(c % 8)) & np.uint32(1)).astype(np.uint64) << np.uint64(c % 64)
            width = np.zeros(len(n), np.int64)
            width[large] = BITS // 64
            small = n <= exact
            kept = values[np.repeat(small, n)].view(np.int64)
            lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(w)]).astype(np.int32)), pa.array(v))
                     for w, v in ((n * small, kept), (width, out.view(np.int64).ravel()))]
            yield pa.record_batch([batch.column("node"), *lists], ["node", "members", "bits"])

    return texts.select("node", "text").mapInArrow(run, "node long, members array<long>, bits array<long>")


def _apart(x: str, y: str) -> Column:
    """In how many bits two arrays of numbers differ."""
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, v: t + v)


def _agreement(x: str, y: str) -> Column:
    """In how many bytes two arrays of 64-bit numbers agree: each byte that differs leaves its lowest bit set."""
    def differing(p: Column, q: Column) -> Column:
        d = p.bitwiseXOR(q)
        for bits in (4, 2, 1):
            d = d.bitwiseOR(F.shiftrightunsigned(d, bits))
        return F.bit_count(d.bitwiseAND(F.lit(0x0101010101010101)))

    return F.lit(FINE) - F.aggregate(F.zip_with(x, y, differing), F.lit(0), lambda t, v: t + v)


def _agreeing(pairs: DataFrame, few: DataFrame) -> DataFrame:
    """The pairs that agree in enough of all coordinates."""
    side = lambda n, c: few.select(F.col("node").alias(n), F.col("fine").alias(c))
    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").where(
        _agreement("x", "y") >= FINE_MATCHES).select("a", "b")


def joined(links: DataFrame, labels: DataFrame) -> DataFrame:
    """``node, comp`` after the links: each component takes its least label.

    Per step every label meets the least label next to it, and chains of
    labels are followed to their end; each step at least halves the labels
    that still have a neighbour.
    """
    labels = materialise(labels, "labels")
    while True:
        a = labels.select(F.col("node").alias("a"), F.col("comp").alias("p"))
        b = labels.select(F.col("node").alias("b"), F.col("comp").alias("q"))
        edges = materialise(
            links.join(a, "a").join(b, "b").where("p <> q").select(
                F.explode(F.array(F.struct("p", "q"), F.struct(F.col("q").alias("p"), F.col("p").alias("q")))).alias("e"))
            .select("e.*").groupBy("p").agg(F.min("q").alias("q")), "edges")
        if edges.isEmpty():
            discard(edges)
            return labels
        up = materialise(edges.select("p", F.least("p", "q").alias("to")), "up")
        discard(edges)
        while True:  # follow chains
            on = up.select(F.col("p").alias("to"), F.col("to").alias("further"))
            longer = up.join(on.where("further <> to"), "to", "left")
            if longer.where("further is not null").isEmpty():
                break
            before, up = up, materialise(longer.select("p", F.coalesce("further", "to").alias("to")), "up")
            discard(before)
        before, labels = labels, materialise(
            labels.join(up.withColumnRenamed("p", "comp"), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")),
            "labels")
        discard(before, up)


def _prefixes(sigs: DataFrame) -> DataFrame:
    """``node, key`` of the postings that have to be merged."""
    key = F.shiftleft(F.col("coord").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    posts, before = sigs.select("node", F.posexplode("sig").alias("coord", "value")).select("node", key.alias("key")), None
    for _ in range(PEELS):
        shared = posts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        kept = materialise(posts.select("node", "key").join(shared, "key"), "postings")
        if before is not None:
            discard(before)
        enough = kept.groupBy("node").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= MATCHES)
        before, posts = kept, kept.join(enough, "node")
    # At most COORDINATES rows a node.
    rarest = F.slice(F.array_sort(F.collect_list(F.struct("n", "key"))), F.lit(1), F.size(F.collect_list("n")) - MATCHES + 1)
    merged = posts.groupBy("node").agg(rarest.alias("keys")).select("node", F.explode("keys").alias("k"))
    out = materialise(merged.select("node", "k.key"), "prefixes")
    discard(before)
    return out


def _open(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """``key, node, comp`` of the lists that lie in several components."""
    state = lists.join(labels, "node").select("key", "node", "comp")
    keys = state.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    return materialise(state.join(keys.select("key"), "key"), "open")


def _with_hubs(state: DataFrame, turn: int) -> DataFrame:
    """``a, b``: each node with a hub of its lists in each other component."""
    order = F.xxhash64("node") if turn == 0 else F.xxhash64("node", "key", F.lit(turn))
    hubs = state.groupBy("key").agg(F.min_by(F.struct("node", "comp"), order).alias("h")).select(
        "key", F.col("h.node").alias("hub"), F.col("h.comp").alias("hub_comp"))
    met = state.join(hubs, "key").where("comp <> hub_comp").groupBy("node", "hub_comp", "hub").agg(F.count(F.lit(1)).alias("n"))
    best = met.groupBy("node", "hub_comp").agg(F.max(F.struct("n", F.xxhash64("hub", "node").alias("o"), "hub"))["hub"].alias("hub"))
    return best.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _near(state: DataFrame, few: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """``a, b, apart`` of the pairs in several components: links where both sets are small (no ``apart``), else pairs whose
    bits are near enough.

    In every list the component with most rows is set against the others, which are few once a group has been joined;
    its rows are never compared with each other.
    """
    most = state.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(
        F.max(F.struct("n", "comp"))["comp"].alias("most"))
    sides = state.join(most, "key").withColumn("minor", F.col("comp") != F.col("most")).drop("most")
    fields = ["key", "node", "comp", "minor", "n", "fine"]
    wide = materialise(sides.join(few.select("node", F.col("n_shingles").alias("n"), "fine"), "node").select(*fields), "wide")
    minor = wide.where("minor")

    def paired(left: DataFrame, right: DataFrame, fields: list[str], met: Column, how: str) -> DataFrame:
        one, other = (df.select(*[F.col(c).alias(f"{c}{k}") for c in fields]) for k, df in ((1, left), (2, right)))
        sizes = (F.col("n1") * 100 >= F.col("n2") * percent) & (F.col("n2") * 100 >= F.col("n1") * percent)
        return one.join(other, (F.col("key1") == F.col("key2")) & (F.col("comp1") != F.col("comp2")) & sizes & met, how)

    # Nodes that agree with some node of another component; each row of a list comes out once at most.
    agree = _agreement("fine1", "fine2") >= FINE_MATCHES
    near = [paired(left, right, fields, agree, "left_semi").select(*[F.col(f"{c}1").alias(c) for c in fields[:-1]])
            for left, right in ((minor, wide), (wide.where("not minor"), minor))]
    near = materialise(near[0].unionByName(near[1]), "near")
    nodes = near.groupBy("node").agg(F.collect_list("key").alias("keys"))  # a node's prefix at most
    made = materialise(_sketches(texts.join(nodes.select("node"), "node"), size, EXACT).join(nodes, "node"), "sketches")
    rest = materialise(near.join(made, "node"), "rest")
    # Two small components meet in the order of their nodes; each pair counts at its first common list.
    once = (~F.col("minor2") | (F.col("node1") < F.col("node2"))) & (
        F.array_min(F.array_intersect("keys1", "keys2")) == F.col("key1"))
    small = F.greatest("n1", "n2") <= EXACT
    both = F.size(F.array_intersect("members1", "members2"))
    alike = F.when(small, 100 * both >= percent * (F.col("n1") + F.col("n2") - both)).otherwise(_apart("bits1", "bits2") <= BITS_APART)
    fields = ["key", "node", "comp", "minor", "n", "keys", "members", "bits"]
    met = paired(rest.where("minor"), rest, fields, once & alike, "inner")
    met = materialise(met.select(
        F.col("node1").alias("a"), F.col("node2").alias("b"), F.when(~small, _apart("bits1", "bits2")).alias("apart")).distinct(), "alike")
    discard(wide, near, made, rest)
    return met


def _links(df: DataFrame, reps: DataFrame, size: int, percent: int) -> DataFrame:
    """``node, comp`` of the nodes that may have partners."""
    lists = prefixes = _prefixes(reps.select("node", "sig"))
    few = materialise(reps.join(lists.select("node").distinct(), "node").drop("sig", "words"), "candidates")
    # Rows that repeat an id and its text are on one partition after the join, so no second shuffle drops them.
    rows = df.select("doc_id", "text", F.xxhash64("text").alias("t"))
    named = few.select(F.col("rep.doc_id").alias("doc_id"), F.col("rep.t").alias("t"), "node")
    texts = materialise(rows.join(named, ["doc_id", "t"]).dropDuplicates(["doc_id", "t"]).select("node", "text"), "texts")
    labels = materialise(few.select("node", F.col("node").alias("comp")), "labels")

    def linked(labels: DataFrame, met: DataFrame) -> tuple[DataFrame, bool]:
        """Labels after the links among the pairs, and whether there are any."""
        links = materialise(_confirmed(met, texts, size, percent), "links")
        found = not links.isEmpty()
        if found:
            before, labels = labels, joined(links, labels)
            discard(before)
        discard(links)
        return labels, found

    state = _open(lists, labels)
    for turn in range(HUB_ROUNDS):
        met = materialise(_agreeing(_with_hubs(state, turn), few), "met")
        labels, found = linked(labels, met)
        before, state = state, _open(state.select("node", "key"), labels)
        discard(met, before)
        if not found and turn:
            break
    met = _near(state, few, texts, size, percent)
    links = met.where("apart is null")
    if not links.isEmpty():
        before, labels = labels, joined(links, labels)
        discard(before)
    # Of the others, first the closest pair of each two components, then what is still in two of them.
    left = met.where("apart is not null").select("a", "b", "apart")
    for tries in (1, 2):
        if left.isEmpty():
            break
        comp = [labels.select(F.col("node").alias(n), F.col("comp").alias(f"c{n}")) for n in "ab"]
        still = left.join(comp[0], "a").join(comp[1], "b").where("ca <> cb")
        if tries == 1:
            two = [F.least("ca", "cb").alias("p"), F.greatest("ca", "cb").alias("q")]
            still = still.groupBy(*two).agg(F.min(F.struct("apart", "a", "b")).alias("m")).select("m.a", "m.b")
        tried = materialise(still.select("a", "b"), "tried")
        labels, _ = linked(labels, tried)
        discard(tried)
    discard(met, state, texts, few, prefixes)
    return labels


def _grouped(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, t, n_shingles, component_id, first`` of every row; ``first`` is the text (its hash) of the least id."""
    made = materialise(signed(docs, size), "signed")
    linked = made.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    reps = materialise(
        linked.groupBy("words").agg(
            F.min(F.struct("doc_id", "t")).alias("rep"), F.first("sig").alias("sig"),
            F.first("fine").alias("fine"), F.first("n_shingles").alias("n_shingles"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")  # numbers of eight bytes, written once
    rows = materialise(made.drop("sig", "fine"), "rows")
    discard(made)
    labels = _links(docs, reps, size, percent)
    comp = F.coalesce(F.col("comp"), F.col("node"))
    ids = reps.select("node", "words", "rep").join(labels, "node", "left").select("words", "rep", comp.alias("comp"))
    least = ids.groupBy("comp").agg(F.min("rep").alias("least"))
    found = materialise(ids.join(least, "comp").select(
        "words", F.col("least.doc_id").alias("component_id"), F.col("least.t").alias("first")), "components")
    discard(reps, labels)
    out = rows.select("doc_id", "t", "n_shingles", "words").join(found, "words", "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "t", "n_shingles", component.alias("component_id"),
                      F.when(~alone, F.col("first")).alias("first"))


def _documents(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    return _grouped(_documents(df, key, text), size, percent).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = PERCENT
) -> DataFrame:
    """``df`` with one row of each group: the one with the least id, of its texts there the one with the least hash.

    Rows are told by id and text, so another text of an id that has to go is judged by its own group, and of rows that
    repeat an id and its text one stays. Rows without id and texts without words stay.
    """
    rows = _grouped(_documents(df, key, text), size, percent).where("first is not null")
    stays = (F.col("doc_id") == F.col("component_id")) & (F.col("t") == F.col("first"))
    verdicts = rows.groupBy(F.col("doc_id").alias("_id"), F.col("t").alias("_t")).agg(
        F.first(stays).alias("_stays"), F.count(F.lit(1)).alias("n"))
    # All rows of an id and text have one verdict; those that stay and are not repeated need no mention.
    verdicts = materialise(verdicts.where("not _stays or n > 1").drop("n"), "verdicts")
    own = (F.col(key).cast("long") == F.col("_id")) & (F.xxhash64(text) == F.col("_t"))
    single = df.join(verdicts, own, "left_anti")
    repeated = df.join(verdicts.where("_stays"), own).dropDuplicates(["_id", "_t"]).select(*[df[c] for c in df.columns])
    return single.unionByName(repeated)
