"""Near-duplicate classes by ProbMinHash, banding and exact verification.

A document is the weighted set of its five-word shingles (weight: how often the
shingle occurs; a text of one to four words is one shingle). Two documents are
linked when their probability Jaccard similarity is 0.8 or more, and a class is
a connected component of links.

1. One pass over the texts gives each document a digest of its word sequence
   and 25 band values of 5 signature registers. Every shingle is a Poisson
   process whose rate is its weight: its arrivals hit random registers, a
   register keeps the shingle of its earliest arrival, and a process ends at
   the first arrival later than all registers.
2. Equal word sequences form exact classes; their smallest id stands for them.
3. Buckets of equal band values are linked by stars: a member is verified
   against a few leaders, those nearest to all others, so a group of any size
   costs a few pairs a member.
4. Then all pairs of a bucket across components are verified. Where they are few they
   are listed. In a hot bucket, members without a link first look for leaders of their
   own; what is still apart is verified block against block, with one link kept for
   each two components that it connects.

No pair of one bucket is left out: step 4 ends only when each is in one component or
was verified.

Two documents of similarity 0.8 share no band with probability (1 - 0.8^5)^25,
5e-5. Defined results: null or empty text is a class of its own; a row with a
null id keeps a null class; an id that occurs with several texts is compared by
the greatest of them; repeated rows each get a row; texts of any length are read
whole; similarity exactly at the threshold links; an empty table gives no rows. Extra
columns are not read."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import _GOLD, TextBytes, map_text, mix, stash, stash_counted, text_slices
from lodestone.llm.components import components
from lodestone.session import ship_package

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5
CROSS_PER_MEMBER = 8             # a bucket with more pairs across components per member is hot
BLOCK, BLOCK_BYTES = 512, 4 << 20   # documents and text bytes of a block of hot buckets, about
BESIDE = 4                       # blocks that one block is verified against in a group
COLUMNS = 4096                   # shingles of a block that are multiplied at a time
LEADERS = 4                      # leaders a member is verified against in a star round
PER_LEADER = 500                 # pairs of one leader that share a copy of its text in the join


def shingles(t: TextBytes):
    """(row, hash, count) of each row's distinct shingles, ordered by row."""
    row, h, _ = t.windows(SHINGLE)
    short = np.flatnonzero((t.n_words > 0) & (t.n_words < SHINGLE))
    if len(short):
        w = t.word_hash()
        whole = [int(xxhash.xxh3_64_intdigest(w[t.first[i]:t.first[i + 1]].tobytes())) for i in short]
        row, h = np.concatenate([row, short]), np.concatenate([h, np.array(whole, dtype=np.uint64)])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return row[at], h[at], np.diff(np.append(at, len(h)))


def prob_min_hash(row, h, weight, n_rows: int, m: int) -> np.ndarray:
    """n_rows x m registers. All processes step together; those past the latest register
    of their row stop."""
    q = np.full(n_rows * m, np.inf)
    z = np.zeros(n_rows * m, dtype=np.uint64)
    last = np.full(n_rows, np.inf)
    x = np.zeros(len(h))
    live = np.arange(len(h))
    step = np.zeros(1, dtype=np.uint64)
    while len(live):
        step += np.uint64(1)
        r = mix(h[live] ^ mix(step * _GOLD))
        u = ((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        x[live] -= np.log(u) / weight[live]
        on = x[live] < last[row[live]]
        live, r = live[on], r[on]
        if len(live) == 0:
            break
        cell = row[live] * m + (mix(r + _GOLD) % np.uint64(m)).astype(np.int64)
        t = x[live]
        np.minimum.at(q, cell, t)
        won = q[cell] == t
        z[cell[won]] = h[live[won]]
        rows = np.unique(row[live])
        last[rows] = q.reshape(n_rows, m)[rows].max(1)
    return z.reshape(n_rows, m)


def band_values(z: np.ndarray) -> np.ndarray:
    """One 64-bit value for each row and band."""
    n = len(z)
    parts = z.reshape(n, BANDS, ROWS)
    out = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD)[None, :].repeat(n, 0)
    for j in range(ROWS):
        out = mix((out ^ parts[:, :, j]) + _GOLD)
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, key (digest of the word sequence, null without words), bands."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                t = TextBytes(part.column(1))
                n = len(t.n_words)
                bands = band_values(prob_min_hash(*shingles(t), n, BANDS * ROWS)).view(np.int64)
                keys = [xxhash.xxh3_128_digest(b" ".join(t.row_bytes(i).split())) if t.n_words[i] else None
                        for i in range(n)]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.binary()), lists],
                                                 ["doc_id", "key", "bands"])

    return map_text(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                F.col(text_col).cast("string").alias("text")),
                    run, "doc_id long, key binary, bands array<long>")


def probability_jaccard(ha, ca, hb, cb) -> float:
    """Exact similarity of two weighted sets (hashes ascending, weights beside them)."""
    both = np.intersect1d(ha, hb, assume_unique=True)
    if len(both) == 0:
        return 0.0
    every = np.union1d(ha, hb)
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, ha)], y[np.searchsorted(every, hb)] = ca, cb
    at = np.searchsorted(every, both)
    total = 0.0
    for ratio, n in zip(*np.unique(x[at] / y[at], return_counts=True), strict=True):
        share = x[at][(x[at] / y[at]) == ratio].sum() if n else 0.0
        total += share / np.maximum(x, ratio * y).sum()
    return float(total)


def _similarities(texts_a: pa.Array, texts_b: pa.Array) -> list[float]:
    sides = []
    for texts in (texts_a, texts_b):
        row, h, c = shingles(TextBytes(texts))
        cut = np.searchsorted(row, np.arange(len(texts) + 1))
        sides.append((h, c, cut))
    (ha, ca, ka), (hb, cb, kb) = sides
    return [probability_jaccard(ha[ka[i]:ka[i + 1]], ca[ka[i]:ka[i + 1]], hb[kb[i]:kb[i + 1]], cb[kb[i]:kb[i + 1]])
            for i in range(len(texts_a))]


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, text_a, text_b). A frequent ``a`` is split over as many copies of its text as it
    has times ``PER_LEADER`` pairs. Texts are joined by shuffle at every size."""
    split = pairs.groupBy("a").agg(F.ceil(F.count("*") / PER_LEADER).cast("int").alias("parts"))
    left = (texts.hint("merge").join(split, texts["id"] == split["a"])
            .select("a", F.col("text").alias("text_a"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))
    dealt = pairs.join(split, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    return (dealt.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
            .join(left.hint("merge"), ["a", "part"]).select("a", "b", "text_a", "text_b"))


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose documents reach the threshold. They are written first: the join reads
    them twice, and a plan that finds them anew each time costs the driver memory."""
    def run(batches):
        for batch in batches:
            for half in text_slices(batch, "text_a"):
                for part in text_slices(half, "text_b"):
                    sim = _similarities(part.column(2), part.column(3))
                    on = pa.array([s >= threshold for s in sim], pa.bool_())
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(on)

    return map_text(_with_texts(stash(pairs, "pairs"), texts), run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, class_id (the smallest id of its class)."""
    signed = stash(signatures(docs, id_col, text_col), "signed")
    named = signed.where("key is not null and doc_id is not null")
    reps = stash(named.groupBy("key").agg(F.min("doc_id").alias("id"), F.min("bands").alias("bands")), "reps")
    rows = reps.select("id", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stash(rows.join(shared, "bucket").groupBy("id").agg(
        F.sum("n").alias("weight"), F.collect_set("bucket").alias("buckets")), "members")      # BANDS at most
    texts = stash(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
                  .join(members.select("id").hint("merge"), "id", "left_semi")
                  .groupBy("id").agg(F.max("text").alias("text")), "texts")
    rows = members.select("id", "weight", F.explode("buckets").alias("bucket"))

    comp = components(stash(verified(_star_pairs(rows.withColumn("comp", F.col("id")), 0), texts, threshold), "links"))
    comp = stash(comp, "comp")               # read by every later step
    placed, seen = _placed(rows, comp)
    if seen["n"]:
        pairs = _cross_pairs(placed.where("not hot").select("bucket", "id", "comp"))
        if seen["hot"]:        # there, members without a link also look for leaders of their own
            pairs = pairs.unionByName(_star_pairs(placed.where("hot and alone"), 1)).distinct()
        comp = _merge(comp, stash(verified(pairs, texts, threshold), "links"))
    if seen["hot"]:
        placed, seen = _placed(placed.where("hot").select("bucket", "id", "weight"), comp)
        if seen["n"]:
            found = verified(_cross_pairs(placed.where("not hot").select("bucket", "id", "comp")), texts, threshold)
            if seen["hot"]:
                found = found.unionByName(_block_links(placed.where("hot").select("bucket", "id", "comp"), texts, threshold))
            comp = _merge(comp, stash(found, "links"))

    least = comp.groupBy("root").agg(F.min("id").alias("class_id"))
    classes = (reps.select("key", F.col("id").alias("rep"))
               .join(comp.join(least, "root").select(F.col("id").alias("rep"), "class_id"), "rep", "left")
               .select("key", F.coalesce("class_id", "rep").alias("class_id")))
    return (signed.select("doc_id", "key").join(classes, "key", "left")
            .select("doc_id",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id")))


def _placed(rows: DataFrame, comp: DataFrame) -> tuple[DataFrame, dict]:
    """The rows of buckets that hold several components, with ``comp``, ``alone`` (no link yet) and
    ``hot``, and how many they are."""
    placed = rows.join(comp, "id", "left").select(
        "bucket", "id", "weight", F.coalesce("root", "id").alias("comp"), F.col("root").isNull().alias("alone"))
    # pairs of a bucket across components, from the sizes of its components
    n = F.col("n")
    cross = (placed.groupBy("bucket", "comp").agg(F.count("*").alias("n")).groupBy("bucket")
             .agg(F.sum(n).alias("n"), F.sum(n * n).alias("own")).where(n * n > F.col("own"))
             .select("bucket", ((n * n - F.col("own")) / 2 > CROSS_PER_MEMBER * n).alias("hot")))
    return stash_counted(placed.join(cross, "bucket"), "placed", n=F.count(F.lit(1)), hot=F.count_if(F.col("hot")))


def _block_links(hot: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links that connect whatever similar members of one bucket are in different components.

    Each member has one block, of its largest bucket: a component that fills half a block has
    blocks of its own, the rest are dealt by component. Two blocks with a bucket in common are
    verified against each other, unless both hold only one and the same component."""
    size = hot.groupBy("bucket").agg(F.count("*").alias("n"))
    homes = (hot.join(size, "bucket").groupBy("id", "comp").agg(F.max(F.struct("n", "bucket"))["bucket"].alias("home"))
             .join(texts.select("id", F.octet_length("text").alias("bytes")).hint("merge"), "id"))
    homes = stash(homes, "homes")
    fill = F.greatest(F.sum("share"), F.lit(0.0))
    own = (homes.groupBy("home", "comp").agg(F.greatest(F.count("*") / BLOCK, F.sum("bytes") / BLOCK_BYTES).alias("share"))
           .withColumn("pure", F.when(F.col("share") >= 0.5, F.col("comp"))))
    parts = own.groupBy("home", "pure").agg(F.ceil(F.sum("share")).cast("long").alias("parts"))
    own = own.join(parts.withColumnRenamed("home", "h").withColumnRenamed("pure", "p"),
                   (F.col("home") == F.col("h")) & F.col("pure").eqNullSafe(F.col("p"))).select("home", "comp", "pure", "parts")
    dealt = F.pmod(F.xxhash64(F.when(F.col("pure").isNull(), F.col("comp")).otherwise(F.col("id"))), F.col("parts"))
    blocked = stash(homes.join(own, ["home", "comp"]).select(
        "id", "comp", "pure", F.concat_ws(":", "home", F.coalesce(F.col("pure").cast("string"), F.lit("")), dealt).alias("block")),
        "blocks")
    at = hot.select("bucket", "id").join(blocked, "id").select("bucket", "block", "pure").distinct()
    meet = (at.select("bucket", F.col("block").alias("x"), F.col("pure").alias("px"))
            .join(at.select("bucket", F.col("block").alias("y"), F.col("pure").alias("py")), "bucket")
            .where("x <= y and (px is null or py is null or px != py)").select("x", "y").distinct())
    meet = stash(meet, "meet")
    # a block is sent once for every BESIDE blocks it meets, and alone to be verified in itself
    place = F.row_number().over(Window.partitionBy("x").orderBy("y"))
    beside = meet.where("x < y").withColumn("g", F.floor((place - 1) / BESIDE))
    sides = (meet.where("x = y").select("x", F.lit(-1).cast("long").alias("g"), F.lit(False).alias("right"), F.col("x").alias("block"))
             .unionByName(beside.select("x", "g", F.lit(False).alias("right"), F.col("x").alias("block")).distinct())
             .unionByName(beside.select("x", "g", F.lit(True).alias("right"), F.col("y").alias("block"))))
    full = blocked.join(texts.select("id", "text").hint("merge"), "id").select("block", "id", "comp", "text")

    def run(table: pa.Table) -> pa.Table:
        left, right = table.filter(pa.compute.invert(table["right"])), table.filter(table["right"])
        a, b = [], []
        for name in pa.compute.unique(right["block"]).to_pylist():
            found = _forest(left, right.filter(pa.compute.equal(right["block"], name)), threshold)
            a, b = a + found[0], b + found[1]
        if not len(right):
            a, b = _forest(left, left, threshold)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    ship_package(hot.sparkSession)
    return (sides.join(full.hint("merge"), "block").select("x", "g", "right", "block", "id", "comp", "text")
            .groupBy("x", "g").applyInArrow(run, "a long, b long"))


def _forest(left: pa.Table, right: pa.Table, threshold: float) -> tuple[list[int], list[int]]:
    """Links (a, b) of two blocks, one for each two components that they connect.

    Of the weights as shares of 1, let p be what one side holds in shared shingles and q what
    the other does; the similarity is at most 1 / (1/p + 1/q - 1), and equal to it without
    repeated shingles. Pairs that reach it are verified, until their components are one."""
    sides = []
    for t in (left, right):
        row, h, c = shingles(TextBytes(t["text"].combine_chunks()))
        cut = np.searchsorted(row, np.arange(len(t) + 1))
        total = np.bincount(row, weights=c, minlength=len(t))
        sides.append((t["id"].to_numpy(), t["comp"].to_numpy(), row, h, c, cut, (c / total[row]).astype(np.float32)))
    (ia, ga, ra, ha, ca, ka, wa), (ib, gb, rb, hb, cb, kb, wb) = sides
    both = np.intersect1d(ha, hb)
    if left is right:
        both = both[np.unique(ha, return_counts=True)[1] > 1]
    p, q = np.zeros((len(ia), len(ib)), np.float32), np.zeros((len(ia), len(ib)), np.float32)
    if len(both):
        (ra_, ua, wa_), (rb_, ub, wb_) = (_by_column(both, *x) for x in ((ra, ha, wa), (rb, hb, wb)))
        for lo in range(0, len(both), COLUMNS):
            dense = []
            for r, u, w, n in ((ra_, ua, wa_, len(ia)), (rb_, ub, wb_, len(ib))):
                i, j = np.searchsorted(u, (lo, lo + COLUMNS))
                m = np.zeros((n, min(COLUMNS, len(both) - lo)), np.float32)
                m[r[i:j], u[i:j] - lo] = w[i:j]
                dense.append(m)
            x, y = dense
            p += x @ (y > 0).astype(np.float32).T
            q += (x > 0).astype(np.float32) @ y.T
    with np.errstate(divide="ignore"):
        bound = 1 / (1 / p + 1 / q - 1)
    on = (bound >= threshold - 1e-3) & (ga[:, None] != gb[None, :])      # float32 sums
    if left is right:
        on = np.triu(on, 1)
    i, j = np.nonzero(on)
    order = np.argsort(-bound[i, j], kind="stable")
    parent = {int(g): int(g) for g in np.concatenate([ga, gb])}

    def root(g):
        while parent[g] != g:
            parent[g] = g = parent[parent[g]]
        return g

    a, b = [], []
    for x, y in zip(i[order].tolist(), j[order].tolist(), strict=True):
        u, v = root(int(ga[x])), root(int(gb[y]))
        if u != v and probability_jaccard(ha[ka[x]:ka[x + 1]], ca[ka[x]:ka[x + 1]],
                                          hb[kb[y]:kb[y + 1]], cb[kb[y]:kb[y + 1]]) >= threshold:
            parent[u] = v
            a.append(int(ia[x]))
            b.append(int(ib[y]))
    return a, b


def _by_column(both, row, h, w):
    """(row, place in ``both``, w) of the entries whose hash is in ``both``, ordered by place."""
    u = np.minimum(np.searchsorted(both, h), len(both) - 1)
    on = np.flatnonzero(both[u] == h)
    on = on[np.argsort(u[on], kind="stable")]
    return row[on], u[on], w[on]


def _merge(comp: DataFrame, found: DataFrame) -> DataFrame:
    """Components after further links: the links join components, and their roots move.
    Every linked id has a row, roots included."""
    ends = found.select("a", "b")
    for end in ("a", "b"):
        ends = (ends.join(comp.select(F.col("id").alias(end), F.col("root").alias("r")), end, "left")
                .withColumn(end, F.coalesce("r", end)).drop("r"))
    moved = components(ends).select(F.col("id").alias("root"), F.col("root").alias("top"))
    known = comp.join(moved, "root", "left").select("id", F.coalesce("top", "root").alias("root"))
    fresh = (moved.select(F.col("root").alias("id"), F.col("top").alias("root"))
             .join(comp.select("id"), "id", "left_anti"))         # ids that were alone until now
    return stash(known.unionByName(fresh), "comp")


def _star_pairs(open_: DataFrame, step: int, leaders: int = LEADERS) -> DataFrame:
    """(a, b): each member b with the ``leaders`` of highest rank among its buckets' leaders that
    are in another component. A bucket's leader is its
    member of highest rank. First the rank is the weight (the sizes of a member's buckets: the
    member nearest to all others has the largest), then the smaller id; later rounds disturb the
    weight by a hash to try other members."""
    shake = F.pmod(F.xxhash64("id", F.lit(step)), F.lit(1 << 20)) / float(1 << 20)
    rank = F.struct(F.col("weight") * (1 + 0.5 * step * shake), -F.col("id"))
    lead = open_.groupBy("bucket").agg(F.max(F.struct(rank.alias("rank"), "id", "comp")).alias("l"))
    best = (open_.join(lead, "bucket").where("comp != l.comp")
            .groupBy("id").agg(F.slice(F.sort_array(F.collect_set("l"), False), 1, leaders).alias("l")))   # BANDS at most
    return best.select("id", F.explode("l").alias("l")).select(F.col("l.id").alias("a"), F.col("id").alias("b"))


def _cross_pairs(open_: DataFrame) -> DataFrame:
    """Every pair of members of one bucket that are in different components; the components
    of a bucket are paired first, so members of one component never meet."""
    parts = open_.select("bucket", "comp").distinct()
    two = parts.select("bucket", F.col("comp").alias("c1")).join(
        parts.select("bucket", F.col("comp").alias("c2")), "bucket").where("c1 < c2")
    one = open_.select("bucket", F.col("comp").alias("c1"), F.col("id").alias("i1"))
    other = open_.select("bucket", F.col("comp").alias("c2"), F.col("id").alias("i2"))
    return (two.join(one, ["bucket", "c1"]).join(other, ["bucket", "c2"])
            .select(F.least("i1", "i2").alias("a"), F.greatest("i1", "i2").alias("b")).distinct())


def keep_one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class, that of the smallest id (if that id repeats, the
    row with the smallest text, then the smallest other columns); rows with a null id stay."""
    classes = near_duplicates(docs, id_col, text_col, threshold)
    kept = classes.where("doc_id = class_id").select(F.col("doc_id").alias(id_col)).distinct()
    named = docs.where(F.col(id_col).isNotNull()).join(kept, id_col, "left_semi")
    least = named.groupBy(id_col).agg(F.min(F.struct(text_col, F.struct(*docs.columns).alias("row"))).alias("least"))
    return least.select("least.row.*").unionByName(docs.where(F.col(id_col).isNull()))
