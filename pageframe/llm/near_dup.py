"""Near-duplicates by bottom-k sketches of one hash function, inverted lists and exact Jaccard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pageframe.llm.common import arrow_map, saved

WORDS = 5
SKETCH = 40       # k: retained hash values of a document
SHARED = 21       # of the k smallest values of a union, a pair at 0.85 shares fewer once in 10**7 pairs or less
PERCENT = 85      # links: 100 * intersection >= PERCENT * union
FEW = 16          # members outside a list's largest component that are compared with all others at once
_CHUNK = 4 << 20


def word_hashes(raws: list):
    """64-bit hashes of all words (A-Z lower-cased, cut at ASCII white space), end to end, and words per text."""
    import numpy as np
    from pandas.util import hash_array

    hashed, pending, counts = [], [], []

    def flush():
        if pending:
            hashed.append(hash_array(np.array(pending, dtype=object), categorize=False))
            pending.clear()

    for raw in raws:
        n, at = 0, 0
        while raw and at < len(raw):                       # a long text goes chunk by chunk, cut at a space
            end = at + _CHUNK
            while end < len(raw) and raw[end] not in b" \t\n\v\f\r":
                end += 1
            words = raw[at:end].lower().split()
            pending.extend(words)
            n, at = n + len(words), end
            if len(pending) > 400_000:
                flush()
        counts.append(n)
    flush()
    return np.concatenate(hashed) if hashed else np.zeros(0, dtype=np.uint64), counts


def shingle_sets(raws: list, width: int = WORDS) -> list:
    """Per text the sorted hashes of its distinct shingles: `width` words, or all words of a shorter text."""
    import numpy as np

    def mixed(x):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    words, counts = word_hashes(raws)
    windows = np.full(max(0, len(words) - width + 1), width, dtype=np.uint64)
    for k in range(width):
        windows = mixed(windows * np.uint64(0x9E3779B97F4A7C15) + words[k:k + len(windows)])
    sets, at = [], 0
    for n in counts:
        if n >= width:
            sets.append(np.unique(windows[at:at + n - width + 1].view(np.int64)))
        elif n:
            short = np.full(1, n, dtype=np.uint64)
            for k in range(n):
                short = mixed(short * np.uint64(0x9E3779B97F4A7C15) + words[at + k:at + k + 1])
            sets.append(short.view(np.int64))
        else:
            sets.append(np.zeros(0, dtype=np.int64))
        at += n
    return sets


def _lists(arrays):
    import numpy as np
    import pyarrow as pa

    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays)))


def text_mark(text: str = "text") -> Column:
    """16 bytes naming a text; null has its own."""
    return F.unhex(F.md5(F.coalesce(F.concat(F.lit("t"), text), F.lit("")).cast("binary")))


def sketches(docs: DataFrame, k: int = SKETCH) -> DataFrame:
    """doc_id, mark, n_shingles, digest of the whole shingle set (null if it is empty) and its k smallest hashes."""

    def run(batch):
        import hashlib

        import pyarrow as pa

        sets = shingle_sets(batch.column("text").cast(pa.binary()).to_pylist())
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "mark": batch.column("mark"), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "digest": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                               pa.binary()),
            "sketch": _lists([s[:k] for s in sets])})

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_mark().alias("mark"), "text"), run,
                     "doc_id long, mark binary, n_shingles long, digest binary, sketch array<long>")


def full_sets(texts: DataFrame) -> DataFrame:
    """rep and the whole shingle set, of (rep, text)."""

    def run(batch):
        import pyarrow as pa

        return pa.RecordBatch.from_pydict({
            "rep": batch.column("rep"), "shingles": _lists(shingle_sets(batch.column("text").cast(pa.binary()).to_pylist()))})

    return arrow_map(texts, run, "rep long, shingles array<long>")


def needed(size: Column) -> Column:
    """Values that two sketches share if their documents link, given the size of one of them."""
    return F.least(F.lit(SHARED), F.ceil(size * PERCENT / 100)).cast("int")


def inverted_lists(classes: DataFrame) -> DataFrame:
    """(value, rep, n, reach): each class under the rarest of its retained values, where two classes share one at least.

    Linked classes share needed() values, so under any common order they share one of the first
    size - needed + 1.  The order here is by number of classes, then value: a passage that many documents
    hold comes last, and unique values, first of all, need no list.  reach is the largest partner's size.
    """
    posts = classes.select("rep", "n", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    shared = saved(posts.groupBy("value").agg(F.count("*").alias("often")).where("often > 1"), "shared-values")
    mine = (posts.join(shared, "value").groupBy("rep", "n", "size")
            .agg(F.array_sort(F.collect_list(F.struct("often", "value"))).alias("known")))
    room = F.greatest(F.lit(0), F.col("size") - needed(F.col("size")) + 1 - (F.col("size") - F.size("known")))
    return mine.select("rep", "n", F.explode(F.slice("known", 1, room)).alias("post")).select(
        "post.value", "rep", "n", F.expr(f"n * 100 div {PERCENT}").alias("reach"))


def difference_groups(rows: DataFrame) -> DataFrame:
    """(pivot, rep, n, component): the members of crowded lists by the pivot of their list.

    A list's pivot is its member that is in most of these lists, so that the lists of one family agree on it.
    """
    lists = rows.groupBy("rep").agg(F.count("*").alias("lists"))
    pivots = rows.join(lists, "rep").groupBy("value").agg(
        F.max_by("rep", F.struct("lists", F.negative("rep"))).alias("pivot"))
    return saved(rows.join(pivots, "value").select("pivot", "rep", "n", "component").distinct(), "groups")


def difference_pairs(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of one group that may link and are not joined through its pivot: an exact filter.

    A member stands for its difference D from the pivot's set.  For two members of sizes n and m the
    symmetric difference is |D| + |E| - 2 |D and E|, and they link when it is at most
    (100 - PERCENT) / (100 + PERCENT) * (n + m).  Where |D| + |E| alone is that small, both link to the
    pivot.  All other links share values of D and E: the values are ordered by frequency in the group,
    rarest first, and if value i of D (from 0) is the first shared one, they share at most |D| - i.
    What most members lack or have in common comes last and is out of reach, so families of near copies
    that miss the threshold make few pairs.
    """
    both = groups.join(sets.toDF("rep", "mine"), "rep").join(sets.toDF("pivot", "center"), "pivot")
    differ = F.concat(F.array_except("mine", "center"), F.array_except("center", "mine"))
    posts = (both.select("pivot", "rep", "n", "component", differ.alias("d"))
             .select("pivot", "rep", "n", "component", F.size("d").alias("size"), F.explode("d").alias("value")))
    posts = saved(posts, "differences")
    shared = saved(posts.groupBy("pivot", "value").agg(F.count("*").alias("often")).where("often > 1"), "shared-differences")
    known = (posts.join(shared, ["pivot", "value"]).groupBy("pivot", "rep", "n", "component", "size")
             .agg(F.array_sort(F.collect_list(F.struct("often", "value"))).alias("known")))
    far = F.col("i") * (100 + PERCENT) * PERCENT <= F.col("n") * (100 - PERCENT) * (100 + PERCENT)
    listed = (known.select("pivot", "rep", "n", "component", "size", F.size("known").alias("common"), F.posexplode("known").alias("pos", "post"))
              .select("pivot", "post.value", "rep", "n", "component", "size", F.expr("size - common + pos").alias("i")).where(far))
    listed = saved(listed, "difference-lists")
    a, b = (listed.select("pivot", "value", *[F.col(c).alias(f"{c}_{side}") for c in ("rep", "n", "component", "size", "i")]) for side in "ab")

    def reach(x, y):
        return (F.col(f"size_{y}") + 2 * F.col(f"i_{x}") - F.col(f"size_{x}")) * (100 + PERCENT) <= (F.col("n_a") + F.col("n_b")) * (100 - PERCENT)

    return (a.join(b, ["pivot", "value"]).where((F.col("rep_a") < F.col("rep_b")) & (F.col("component_a") != F.col("component_b"))
                                                & reach("a", "b") & reach("b", "a")).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct())


def fit(a: str, b: str) -> Column:
    return (F.col(f"n_{a}") <= F.col(f"reach_{b}")) & (F.col(f"n_{b}") <= F.col(f"reach_{a}"))


def posting(rows: DataFrame, side: str, source: str = "") -> DataFrame:
    """Columns of a list's members under the names of one side of a pair."""
    return rows.select("value", *[F.col(source + c).alias(f"{name}_{side}" if name else side) for c, name in (
        ("rep", ""), ("n", "n"), ("reach", "reach"), ("component", "c"))])


class Links:
    """Links found so far between class representatives, and the check of candidate pairs."""

    def __init__(self, docs: DataFrame, classes: DataFrame):
        self.docs, self.classes, self.found = docs, classes, None

    def sets(self, reps: DataFrame) -> DataFrame:
        """The whole shingle sets (rep, shingles) of some representatives, made from their texts."""
        known = saved(self.classes.select("rep", "first.doc_id", "first.mark").join(reps.select("rep"), "rep", "left_semi"), "representatives")
        texts = self.docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(known.select("doc_id").distinct(), "doc_id", "left_semi")
        texts = texts.withColumn("mark", text_mark()).join(known, ["doc_id", "mark"])       # few are left; a doc_id may have several texts
        return saved(full_sets(texts.select("rep", "text")).dropDuplicates(["rep"]), "shingle-sets")

    def add(self, pairs: DataFrame) -> None:
        """Check pairs (a, b) of representatives: sizes and union sketch first, then the whole sets."""
        light = self.classes.select("rep", "sketch")
        both = (pairs.join(light.toDF("a", "sketch_a"), "a").join(light.toDF("b", "sketch_b"), "b"))
        union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, SKETCH)
        shared = F.size(F.array_intersect(F.array_intersect("sketch_a", "sketch_b"), F.col("union")))
        likely = saved(both.withColumn("union", union).where(shared >= needed(F.size("union"))).select("a", "b"), "likely-pairs")
        sets = self.sets(likely.select(F.explode(F.array("a", "b")).alias("rep")).distinct())
        joined = likely.join(sets.toDF("b", "set_b"), "b").join(sets.toDF("a", "set_a"), "a")
        same = F.size(F.array_intersect("set_a", "set_b"))
        link = joined.where(same * 100 >= (F.size("set_a") + F.size("set_b") - same) * PERCENT).select("a", "b")
        link = saved(link, "links")
        self.found = link if self.found is None else self.found.unionByName(link)


def components(links: DataFrame) -> DataFrame:
    """(rep, component): the smallest representative reachable over the links (a, b), for those that have one.

    Every round takes the smallest label among the neighbours, then the label of that label, until
    nothing changes; each round is a written table.
    """
    edges = saved(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = saved(edges.groupBy(F.col("a").alias("rep")).agg(F.least(F.min("b"), F.col("a")).alias("component")), "labels")
    while True:
        near = edges.join(labels.toDF("b", "next"), "b").groupBy(F.col("a").alias("rep")).agg(F.min("next").alias("next"))
        step = labels.join(near, "rep").select("rep", F.least("component", "next").alias("next"), F.col("component").alias("before"))
        jump = labels.toDF("next", "far")
        moved = saved(step.join(jump, "next", "left")
                      .select("rep", F.least("next", F.coalesce("far", "next")).alias("component"), "before"), "labels")
        labels = moved.select("rep", "component")
        if not moved.where("component < before").limit(1).count():
            return labels


def open_lists(lists: DataFrame, labels: DataFrame, led: DataFrame) -> DataFrame:
    """The lists whose members are in several components, without members that led them, and per list the
    largest component (`major`) and the number of members outside it (`others`)."""
    now = (lists.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
           .join(led, ["value", "rep"], "left_anti"))
    groups = now.groupBy("value", "component").agg(F.count("*").alias("members"))
    mixed = (groups.groupBy("value").agg(
        F.max_by("component", F.struct("members", F.negative("component"))).alias("major"), F.count("*").alias("parts"),
        (F.sum("members") - F.max("members")).alias("others")).where("parts > 1"))
    return saved(now.join(mixed, "value"), "open-lists")


def pairs_of(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct pairs of members of one list in different components whose sizes allow a link."""
    return (posting(left, "a").join(posting(right, "b"), "value").where((F.col("c_a") != F.col("c_b")) & fit("a", "b"))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def linked(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(rep, component) for the representatives with a link.

    1. In every inverted list of retained values the first member leads: all others are compared with it.
    2. Members that now share a component need no comparison.  Lists with at most FEW members outside
       their largest component have these compared with all others.
    3. The other lists, many documents alike but not linked, go by their members' differences from a
       pivot (`difference_pairs`): all are compared with the pivot, and an exact filter names the rest.

    So every pair that shares a list is compared, ruled out exactly or already in one component, and no
    list is expanded into all its pairs.
    """
    lists = saved(inverted_lists(classes), "lists")
    links = Links(docs, classes)
    lead = saved(lists.groupBy("value").agg(F.min(F.struct("rep", "n", "reach")).alias("lead"), F.count("*").alias("m"))
                 .where("m > 1").select("value", "lead.*"), "leaders")
    apart = F.col("rep").alias("component")
    links.add(pairs_of(lead.select("*", apart), lists.select("*", apart)))
    labels = components(links.found)
    rows = open_lists(lists, labels, lead.select("value", "rep"))
    few, many = rows.where(F.col("others") <= FEW), rows.where(F.col("others") > FEW)
    pairs = pairs_of(few.where("component != major"), few)
    if many.limit(1).count():
        groups = difference_groups(many)
        pivots = groups.where("pivot <> rep").select(F.least("pivot", "rep").alias("a"), F.greatest("pivot", "rep").alias("b"))
        sets = links.sets(groups.select("rep").distinct())
        pairs = pairs.union(pivots).union(difference_pairs(groups, sets)).distinct()
    links.add(pairs)
    return components(links.found)


def judged(docs: DataFrame) -> DataFrame:
    """Per document doc_id, mark, n_shingles, component_id and stays: whether it is the one of its component to keep.

    A class of equal sets goes by the smallest doc_id among its documents.  A doc_id whose rows have different sets
    stands for several classes: they go by hashes of doc_id and set instead, so that no class takes another's links.
    """
    thin = saved(sketches(docs), "sketches")
    known = thin.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    twice = known.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low <> high")
    twice = saved(twice.select("doc_id", F.lit(True).alias("twice")), "repeated-ids")
    named = known.join(twice, "doc_id", "left").withColumn("uid", F.when(F.col("twice"), F.xxhash64("doc_id", "digest")).otherwise(F.col("doc_id")))
    row = F.struct("doc_id", "mark")
    classes = saved(named.groupBy("digest").agg(F.min("uid").alias("rep"), F.min(row).alias("first"), F.first("n_shingles").alias("n"),
                                                F.first("sketch").alias("sketch")), "classes")
    labels = linked(docs, classes)
    placed = classes.select("digest", "rep", "first").join(labels, "rep", "left").select("digest", "first", F.coalesce("component", "rep").alias("component"))
    firsts = placed.groupBy("component").agg(F.min("first").alias("least"))
    found = thin.join(placed.join(firsts, "component").select("digest", "least"), "digest", "left")
    alone = F.col("least").isNull() | F.col("doc_id").isNull()
    return found.select("doc_id", "mark", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("least.doc_id", "doc_id")).alias("component_id"),
                        (alone | (row == F.col("least"))).alias("stays"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document doc_id, n_shingles, component_id and kept.

    Two documents link when their sets of five-word shingles have a Jaccard similarity of 0.85 or more;
    component_id is the smallest doc_id reachable over links, kept marks the document that bears it.
    Equal sets form one class, compared once.  A pair at the threshold is missed only when its sketches
    share fewer than SHARED values (about one pair in ten million); every link is confirmed on whole sets.

    A null or empty text, or one without words, has no shingles, links with nothing and is kept.  A row
    without doc_id links with nothing, has no component and is kept.  Rows that repeat a doc_id are documents
    of their own, which get the same component when their texts link; columns besides doc_id and text are not read.
    """
    return judged(docs).select("doc_id", "n_shingles", "component_id",
                               F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with all their columns, but one of each component only; of rows with equal id and text, one stays.

    A document goes by its id and text, so another text under the same id stays.  Rows without doc_id all stay.
    """
    gone = judged(docs).where("NOT stays").select(F.col("doc_id").alias("_gone"), F.col("mark").alias("_mark")).distinct()
    alone = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    marked = docs.withColumns({"_alone": alone, "_same": text_mark()})
    left = marked.join(gone, (F.col("doc_id") == F.col("_gone")) & (F.col("_same") == F.col("_mark")), "left_anti")
    return left.dropDuplicates(["doc_id", "_same", "_alone"]).select(*[F.col(f"`{c}`") for c in docs.columns])
