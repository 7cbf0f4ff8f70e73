"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

Every text is a set of word shingles. Its MinHash signature has a branch of DEPTH values in each of TREES trees. The
branches of a tree, sorted, are its prefix trie: texts below one trie node are neighbours in the order. A text's match
starts at the whole branch and is shortened, level by level, until a partner of the least similarity that its own set
can have at or above the threshold meets it in some tree with the target recall. Small sets have few similarities
to choose from (a set of 3 shingles has no partner between 0.8 and 1), so they stop at long prefixes; sets that can
have a partner right at the threshold are shortened furthest. Two texts meet at the longer of their prefixes.

The forest is sorted by range with the text's node last in the key, so a trie node that holds a third of all texts is
spread over partitions like any other rows; runs that cross partitions are tied by a few rows per partition.

Texts that meet anywhere form candidate groups, and inside a group every pair is verified on its whole shingle sets,
so links found on the way by no tree count as well. What keeps groups of copies cheap: equal texts are one node with a
count; a trie node links its texts to its first one only, not to each other; verification gets each text of a group
once, splits large groups into blocks whose pairs are tasks of their own, and passes on a link count and one spanning
edge per text, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from barlake.llm.ragged import PieceTable, byte_texts, free_name, ragged_index, slices, starts_of
from barlake.workspace import materialise

WORDS = 5
THRESHOLD = 0.8
TREES = 32
#: Values of a branch, a byte each: values that differ agree by chance once in 256, which only adds candidates.
DEPTH = 10
RECALL = 0.999
#: Sets of fewer shingles have a prefix of their own; larger ones count as able to have any similarity.
SMALL_SET = 64
#: What a verifying task holds, about: shingles, and so many for each text besides.
UNIT_SHINGLES = 1 << 19
TEXT_SHINGLES = 256
#: A hash of more sets than this is counted by matrix products.
FEW = 24
#: Stands for a null doc_id in join keys. A row that has it as its id has an equal text where keys meet, too.
NO_ID = -(1 << 63)
#: The column that ``one_of_each`` adds to documents while it chooses.
TEXT_KEY = "_text_key"
#: A node with more than one in so many edges is looked up in a broadcast table, of fewer rows than this.
HOT_SHARE = 512
SIGNED = pa.schema([("doc_id", pa.int64()), ("key", pa.string()), ("shingles", pa.int64()), ("length", pa.int32()), ("branches", pa.binary())])
#: A tie of two nodes; or, with ``run``, a node that stands for a run of equal prefixes that may go on elsewhere.
TIES = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("run", pa.binary())])
CHECKED = pa.schema([("node", pa.int64()), ("label", pa.int64()), ("links", pa.int64()), ("split", pa.bool_())])

_words: list[PieceTable] = []


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold meets in some tree with probability ``recall``."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def word_codes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), np.ones(len(words), np.int64)


def shingles(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of every text, and how many each has (repeats included).

    A text of fewer words is one shingle, a text without a word has none. Words are runs of characters other
    than ASCII white space, taken as they are.
    """
    if not _words:
        _words.append(PieceTable(word_codes, np.uint64, limit=300_000))
    split = [t.split() for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    rows = _words[0].rows([w for own in split for w in own])
    codes = _words[0].values[_words[0].starts[rows]]
    counts = np.where(sizes >= words, sizes - words + 1, np.minimum(sizes, 1))
    at = ragged_index(starts_of(sizes), counts)
    last = np.repeat(np.cumsum(sizes), counts)  # where the shingle's text ends
    mixed = np.zeros(len(at), np.uint64)
    for k in range(words):
        inside = at + k < last
        word = codes[np.minimum(at + k, max(0, len(codes) - 1))] if len(codes) else codes
        mixed = np.where(inside, mixed * np.uint64(0x9E3779B97F4A7C15) + word, mixed)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32)), counts


def least_similarity(size: int, threshold: Fraction) -> Fraction:
    """The least similarity of at least ``threshold`` that a set of ``size`` shingles can have to any set."""
    least = -(-threshold.numerator * size // threshold.denominator)
    unions = ((shared, shared * threshold.denominator // threshold.numerator) for shared in range(max(1, least), size + 1))
    return min((Fraction(shared, union) for shared, union in unions if union >= size), default=Fraction(1))


def prefix_lengths(threshold: float, recall: float, small: int = SMALL_SET) -> np.ndarray:
    """How far a match is shortened, by the size of the set; the last entry is for all sizes from there on."""
    share = Fraction(threshold).limit_denominator(10_000)
    lengths = [prefix_length(float(least_similarity(size, share)), recall=recall) for size in range(1, small)]
    whole = prefix_length(threshold, recall=recall)
    return np.array([DEPTH, *lengths, whole], np.int32)


def set_sizes(hashes: np.ndarray, counts: np.ndarray, small: int = SMALL_SET) -> np.ndarray:
    """How many different shingles each text has, or ``small`` for as many shingles and more."""
    sizes = np.minimum(counts, small)
    starts = starts_of(counts)
    for at in np.flatnonzero((counts > 1) & (counts < small)):
        sizes[at] = len(np.unique(hashes[starts[at] : starts[at] + counts[at]]))
    return sizes


def branches(hashes: np.ndarray, counts: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> np.ndarray:
    """A row of trees x depth bytes per text that has shingles: its branch in every tree, one after the other."""
    rng = np.random.default_rng(29)
    factors = rng.integers(0, 1 << 32, (trees, depth), dtype=np.uint32) | np.uint32(1)
    offsets = rng.integers(0, 1 << 32, (trees, depth), dtype=np.uint32)
    points = (hashes >> np.uint64(32)).astype(np.uint32)
    starts = starts_of(counts)[counts > 0]
    out = np.empty((len(starts), trees, depth), np.uint8)
    for tree in range(trees):
        for level in range(depth):
            least = np.minimum.reduceat(points * factors[tree, level] + offsets[tree, level], starts)
            out[:, tree, level] = (least * np.uint32(0x9E3779B1)) >> np.uint32(24)
    return out.reshape(len(starts), trees * depth)


def tie_runs(batches: Iterator[pa.RecordBatch], shortest: int, depth: int = DEPTH) -> Iterator[pa.RecordBatch]:
    """Ties between the nodes of one range of the sorted forest (tree, branch, node, length).

    At every length, texts whose match is shortened to it or further and whose prefixes of that length are equal
    follow each other. Such a run ties the texts of just that length to its first one, and others to the one before
    if that has just that length; others among themselves are tied at their own, shorter lengths. Only the last row
    of each length is carried from batch to batch. The first and the last run of a range may go on in its
    neighbours: they come back under tree and prefix, to be tied there.
    """
    carried: dict[int, tuple[bytes, int, int, int]] = {}  # length: prefix, first node of the run, last node, its length
    for batch in batches:
        if not batch.num_rows:
            continue
        tree, node, own = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2, 3))
        codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, depth)
        codes = np.column_stack([tree.astype(np.uint8), codes])
        us, vs, runs = [], [], []
        for length in range(shortest, depth + 1):
            part = np.flatnonzero(own <= length)
            if not len(part):
                continue
            prefix, nodes, lengths = codes[part, : length + 1], node[part].astype(np.int64), own[part]
            same = np.concatenate([[False], (prefix[1:] == prefix[:-1]).all(axis=1)])
            before, before_length = np.roll(nodes, 1), np.roll(lengths, 1)
            first = nodes[np.maximum.accumulate(np.where(same, 0, np.arange(len(part))))]
            if length not in carried:
                runs.append((int(nodes[0]), bytes([length]) + prefix[0].tobytes()))
            elif carried[length][0] == prefix[0].tobytes():
                _, head, last, last_length = carried[length]
                goes_on = np.cumsum(~same) == 1
                first = np.where(goes_on, head, first)
                same[0], before[0], before_length[0] = True, last, last_length
            exact = same & (lengths == length)
            after = same & (lengths < length) & (before_length == length)
            us += [nodes[exact], nodes[after]]
            vs += [first[exact], before[after]]
            carried[length] = (prefix[-1].tobytes(), int(first[-1]), int(nodes[-1]), int(lengths[-1]))
        u, v = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (us, vs))
        apart = u != v
        found = pa.array(u[apart]), pa.array(v[apart]), pa.nulls(int(apart.sum()), pa.binary())
        yield pa.RecordBatch.from_arrays(list(found), schema=TIES)
        yield _run_rows(runs)
    yield _run_rows([(head, bytes([length]) + prefix) for length, (prefix, head, _, _) in carried.items()])


def _run_rows(runs: list[tuple[int, bytes]]) -> pa.RecordBatch:
    nodes = pa.array([n for n, _ in runs], pa.int64())
    return pa.RecordBatch.from_arrays([nodes, nodes, pa.array([r for _, r in runs], pa.binary())], schema=TIES)


def meetings(nodes: DataFrame, shortest: int) -> DataFrame:
    """Ties (u, v) between nodes (node, length, branches) that meet in some tree; reach over ties is what counts."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    placed = nodes.select("node", "length", "branches", tree)
    placed = placed.select("tree", F.substring("branches", F.col("tree") * DEPTH + 1, F.lit(DEPTH)).alias("branch"), "node", "length")
    forest = placed.repartitionByRange("tree", "branch", "node").sortWithinPartitions("tree", "branch", "node")
    found = materialise(forest.mapInArrow(lambda batches: tie_runs(batches, shortest), from_arrow_schema(TIES)), "ties")
    ends = found.filter("run is not null").select("u", "run")
    across = ends.join(ends.groupBy("run").agg(F.min("u").alias("v")), "run").select("u", "v").filter("u != v")
    return found.filter("run is null").select("u", "v").distinct().union(across)


def _fingerprint(edges: DataFrame) -> tuple:
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).head()


def _to_least(edges: DataFrame, least: DataFrame, most: int) -> DataFrame:
    """``edges`` (u, v), at most ``most``, with m of their u from ``least`` (u, m, n edges). A u of more than one in
    HOT_SHARE of them is broadcast; there are fewer than HOT_SHARE such."""
    often = F.col("n") > max(1, most // HOT_SHARE)
    hot = F.broadcast(least.filter(often).select("u", F.col("m").alias("hot_m")))
    marked = edges.join(hot, "u", "left")
    rare = marked.filter("hot_m is null").select("u", "v").join(least.filter(~often).select("u", "m"), "u")
    return rare.unionByName(marked.filter("hot_m is not null").select("u", "v", F.col("hot_m").alias("m")))


def components(edges: DataFrame, label: str = "component") -> DataFrame:
    """node and label (the least node that it is linked to, over any way) of every node of ``edges`` (u, v).

    Stars alternate: every node's greater neighbours are tied to its least neighbour, then its smaller ones.
    Each round is written to the shared folder, so lineage stays short and a lost executor costs one round at
    most. A node's neighbours are only ever reduced to their least or joined to it, never gathered; nodes of very many
    edges are joined by broadcast, so no task gets the centre of a large star.
    """
    edges = edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialise(edges, "edges")
    before = _fingerprint(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        least = least.select("u", F.least("u", "m").alias("m"), "n")
        large = _to_least(both, least, 2 * before[0]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = _to_least(large, least, 2 * before[0]).select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = materialise(small.select("e.u", "e.v").filter("u != v").distinct(), "edges")
        now = _fingerprint(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias(label))


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many hashes each two sets share, as a square matrix whose upper half counts.

    Hashes of few sets are counted pair by pair, those of many by products of a membership matrix, some columns
    at a time; so neither many rare hashes nor a few frequent ones cost the product of the two.
    """
    n = len(sets)
    both = np.zeros((n, n), np.float32)
    if n == 2:
        both[0, 1] = len(np.intersect1d(*sets, assume_unique=True))
        return both
    owner = np.repeat(np.arange(n), list(map(len, sets)))
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")  # within a hash, places rise
    owner, column = owner[order], column[order]
    seldom = (times[column] > 1) & (times[column] <= FEW)
    rows, own = owner[seldom], column[seldom]
    flat = both.ravel()
    for step in range(1, FEW):
        same = np.flatnonzero(own[step:] == own[:-step])
        if not len(same):
            break
        np.add.at(flat, rows[same] * n + rows[same + step], 1)
    often = times[column] > FEW
    rows, own = owner[often], (np.cumsum(times > FEW) - 1)[column[often]]
    width = max(64, (1 << 21) // n)
    for first in range(0, int(own[-1]) + 1 if len(own) else 0, width):
        i, j = np.searchsorted(own, (first, first + width))
        member = np.zeros((n, min(width, int(own[-1]) + 1 - first)), np.float32)
        member[rows[i:j], own[i:j] - first] = 1
        both += member @ member.T
    return both


def linked_pairs(sets: list[np.ndarray], threshold: Fraction, blocks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rising places whose sets of sorted hashes have a Jaccard similarity of at least ``threshold``.
    With ``blocks``, only pairs of different blocks."""
    n, sizes = len(sets), np.fromiter(map(len, sets), np.int64, len(sets))
    shared, left, right = shared_counts(sets), [], []
    for first in range(0, n, 256):
        some = shared[first : first + 256].astype(np.int64)
        union = sizes[first : first + 256, None] + sizes[None, :] - some
        linked = threshold.denominator * some >= threshold.numerator * union
        if blocks is not None:
            linked &= blocks[first : first + 256, None] != blocks[None, :]
        i, j = np.nonzero(linked)
        rising = j > i + first
        left.append(i[rising] + first)
        right.append(j[rising])
    return np.concatenate(left), np.concatenate(right)


def least_of(n: int, left: np.ndarray, right: np.ndarray, names: np.ndarray) -> np.ndarray:
    """For each of ``n`` places, the least name among those it is linked to over any way."""
    label = names.copy()
    while True:
        least = label.copy()
        np.minimum.at(least, left, label[right])
        np.minimum.at(least, right, label[left])
        if (least == label).all():
            return label
        label = least


def classes_of(
    docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, recall: float = RECALL
) -> tuple[DataFrame, DataFrame]:
    """All rows as doc_id, key (of the text) and shingles; and for every text that has a word its key, node,
    first_id (the least doc_id that has it), n_copies, links to other texts' rows (null for none), and its class:
    class_id, the least doc_id, and class_key, the text that has it. Classes are told apart by class_key; doc_ids
    only name rows, so texts of one doc_id are texts of their own, and rows without one take part."""
    lengths = prefix_lengths(threshold, recall)
    share = Fraction(threshold).limit_denominator(10_000)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = rows.withColumn("key", F.md5("text")).withColumn("id", F.coalesce("doc_id", F.lit(NO_ID)))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column(2))
            for i, j in slices(texts):
                hashes, counts = shingles(texts[i:j], words)
                found = iter(branches(hashes, counts))
                rows = pa.array([next(found).tobytes() if n else None for n in counts], pa.binary())
                columns = [batch.column(k).slice(i, j - i) for k in (0, 1)]
                columns += [pa.array(counts), pa.array(lengths[set_sizes(hashes, counts)]), rows]
                yield pa.RecordBatch.from_arrays(columns, schema=SIGNED)

    signed = keyed.select("doc_id", "key", "text").mapInArrow(sign, from_arrow_schema(SIGNED))
    signed = materialise(signed, "signed")
    # a node is a text, numbered once as it is written
    nodes = (
        signed.filter("shingles > 0")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.first(F.struct("shingles", "length", "branches")).alias("found"),
            F.count(F.lit(1)).alias("n_copies"),
        )
        .select("key", F.monotonically_increasing_id().alias("node"), "first_id", "found.*", "n_copies")
    )
    nodes = materialise(nodes, "nodes")
    groups = components(meetings(nodes, int(lengths.min())), "grp")
    groups = groups.union(groups.select(F.col("grp").alias("node"), "grp")).distinct()

    # a group of many shingles is cut into blocks, and every pair of blocks is a task; small groups share tasks
    members = nodes.select("node", "key", F.coalesce("first_id", F.lit(NO_ID)).alias("id"), "shingles", "n_copies").join(groups, "node")
    totals = members.groupBy("grp").agg(F.sum(F.col("shingles") + TEXT_SHINGLES).alias("total"))
    whole = totals.agg(F.sum("total")).head()[0] or 0
    bins = max(1, -(-whole // UNIT_SHINGLES))
    totals = totals.select("grp", F.ceil(F.col("total") / UNIT_SHINGLES).cast("int").alias("n_blocks"))
    members = materialise(members.join(totals, "grp"), "members")
    block = F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int")
    dealt = (
        members.withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .select(
            "node", "id", "key", "n_copies", "grp", "block",
            (F.col("n_blocks") > 1).alias("split"),
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            F.when(F.col("n_blocks") > 1, F.col("grp")).otherwise(F.pmod(F.xxhash64("grp"), F.lit(bins))).alias("bin"),
        )
    )
    texts = keyed.join(members.select("id", "key").distinct(), ["id", "key"], "left_semi")
    texts = texts.groupBy("id", "key").agg(F.first("text").alias("text"))
    units = dealt.join(texts, ["id", "key"])

    def verify(unit: pa.Table) -> pa.Table:
        unit = unit.sort_by("grp")
        texts = byte_texts(unit.column("text"))
        grp, block = unit.column("grp").to_numpy(), unit.column("block").to_numpy()
        node, copies = unit.column("node").to_numpy(), unit.column("n_copies").to_numpy()
        hashes, counts = shingles(texts, words)
        sets = [np.unique(s) for s in np.split(hashes, np.cumsum(counts)[:-1])]
        label, links = node.copy(), np.zeros(len(node), np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], grp[1:] != grp[:-1], [True]]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a < 2:
                continue
            own = block[a:b] if unit.column("i")[0].as_py() != unit.column("j")[0].as_py() else None
            left, right = linked_pairs(sets[a:b], share, own)
            np.add.at(links, a + left, copies[a + right])
            np.add.at(links, a + right, copies[a + left])
            label[a:b] = least_of(b - a, left, right, node[a:b])
        return pa.table([pa.array(node), pa.array(label), pa.array(links), unit.column("split")], schema=CHECKED)

    checked = units.groupBy("bin", "split", "i", "j").applyInArrow(verify, from_arrow_schema(CHECKED))
    checked = materialise(checked, "checked")
    links = checked.groupBy("node").agg(F.sum("links").alias("links"), F.min("label").alias("label"))
    # labels of blocks of one group are tied together; others are already the least of their class
    tied = components(checked.filter("split").select(F.col("node").alias("u"), F.col("label").alias("v")), "tied")
    links = links.join(tied, "node", "left").select("node", "links", F.coalesce("tied", "label").alias("label"))
    # the text of a class that has its least doc_id, by key among equals, names it
    named = nodes.select("key", "node", "first_id")
    linked = materialise(links.join(named, "node"), "linked")
    name = F.struct(F.col("first_id").isNull(), F.col("first_id").alias("id"), "key")
    names = linked.groupBy("label").agg(F.min(name).alias("name"))
    names = names.select("label", F.col("name.id").alias("class_id"), F.col("name.key").alias("class_key"))
    linked = materialise(linked.join(names, "label").select("node", "links", "class_id", "class_key"), "named")
    classes = nodes.select("key", "node", "first_id", "n_copies").join(linked, "node", "left")
    alone = F.col("class_key").isNull()
    classes = classes.withColumns(
        {"class_id": F.when(alone, F.col("first_id")).otherwise(F.col("class_id")), "class_key": F.coalesce("class_key", "key")}
    )
    return signed.select("doc_id", "key", "shingles"), classes


def join_documents(
    docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, recall: float = RECALL
) -> DataFrame:
    """doc_id, class_id, n_copies and n_links of every document (doc_id, text; other columns are ignored).

    Two documents are linked if the Jaccard similarity of their sets of ``words``-word shingles is at least
    ``threshold``; a class is all that links reach, named by its least doc_id; n_links counts the documents that
    one is linked to, n_copies those of the same text, itself included. Null texts, and texts without a word,
    are linked to nothing and are classes of their own. Every row is a document: rows without a doc_id take part
    as others do, and a class of such rows only has a null name. Different texts of one doc_id are in one class
    only if links reach from one to the other; if not, their classes may bear the same name.
    """
    rows, classes = classes_of(docs, threshold, words, recall)
    result = rows.select("doc_id", F.when(F.col("shingles") > 0, F.col("key")).alias("key")).join(classes, "key", "left")
    return result.select(
        "doc_id",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        (F.coalesce("n_copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
    )


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, recall: float = RECALL) -> DataFrame:
    """``docs`` (doc_id, text and any columns) with one document of each class: that of the least doc_id, or one
    without a doc_id where the class has no other.

    Of several rows of that doc_id and text the least stays, columns compared in their order. Rows without a word
    are classes of their own: those of one doc_id and text are one, those without a doc_id all stay. Columns may have
    any names and keep their values.
    """
    text_key = free_name(TEXT_KEY, docs.columns)
    rows, classes = classes_of(docs, threshold, words, recall)
    rows = rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.coalesce("key", F.lit("")).alias(text_key), "doc_id", "shingles")
    chosen = classes.filter("key = class_key").select(F.coalesce("first_id", F.lit(NO_ID)).alias("id"), F.col("key").alias(text_key))
    stays = rows.filter("shingles > 0").join(chosen, ["id", text_key], "left_semi").unionByName(rows.filter("shingles = 0 and doc_id is not null"))
    stays = materialise(stays.groupBy("doc_id", text_key).agg(F.count(F.lit(1)).alias("n")), "stays")
    text = F.col("text").cast("string")
    keyed = docs.withColumn(text_key, F.coalesce(F.md5(text), F.lit("")))
    same = keyed["doc_id"].cast("long").eqNullSafe(stays["doc_id"]) & (keyed[text_key] == stays[text_key])
    single = keyed.join(stays.filter("n = 1"), same, "left_semi")
    several = keyed.join(stays.filter("n > 1"), same, "left_semi")
    several = several.groupBy("doc_id", text_key).agg(F.min(F.struct(*docs.columns)).alias("row"))
    wordless = ~F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    nameless = docs.filter(F.col("doc_id").cast("long").isNull() & wordless)
    return single.select(*docs.columns).unionByName(several.select("row.*")).unionByName(nameless)
