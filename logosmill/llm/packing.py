"""Problem 7: filling fixed-capacity containers with items.

The histogram of exact item lengths (bounded by the capacity) is all that a plan
needs. A configuration says how many items of each length a container holds. The
configuration program (least containers that cover the histogram, in fractions)
is solved by multiplicative weights: each step prices the lengths, a knapsack
dynamic program finds the configuration of most value, it is used for a share of
what is left, and lengths that run out faster than the rest lose weight. Prices
are also a dual solution: their total over the most that a container can be
worth bounds the number of containers from below. The solution is rounded down
to whole containers; what is left over goes by best fit, largest first, for all
items of a length at once. Items then take their places by their rank within
their length, a distributed count.
"""

from __future__ import annotations

import base64
import bisect
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Share of what is left that a step uses, and lengths that it prices.
ETA, PRICED = 0.1, 64
#: Share of the total size that is left to best fit, which needs items of all lengths to fill well.
REST = 0.05
#: With more lengths than so many, steps use a larger share, so that their number stays about the same.
STEPS_FOR = 1000
# Fixed value: how the byte-pair vocabularies part a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
Config = tuple[np.ndarray, np.ndarray, int]  # numbers of lengths, items of each in a container, containers


def knapsack(sizes: np.ndarray, values: np.ndarray, most: np.ndarray, cap: int) -> np.ndarray:
    """How many of each item give the most value in ``cap``; at most ``most`` of each."""
    best = np.zeros(cap + 1)
    took = []
    for i in range(len(sizes)):
        s, v, m = int(sizes[i]), float(values[i]), int(min(most[i], cap // sizes[i]))
        part, k = 1, []
        while m > 0:
            n = min(part, m)
            m -= n
            part *= 2
            w = n * s
            if w > cap:
                break
            new = best[: cap + 1 - w] + n * v
            better = new > best[w:] + 1e-12
            flag = np.zeros(cap + 1, bool)
            flag[w:] = better
            best[w:] = np.where(better, new, best[w:])
            k.append((n, flag))
        took.append(k)
    out = np.zeros(len(sizes), np.int64)
    at = int(best.argmax())
    for i in range(len(sizes) - 1, -1, -1):
        for n, flag in reversed(took[i]):
            if flag[at]:
                out[i] += n
                at -= n * int(sizes[i])
    return out


def most_valuable(sizes: np.ndarray, values: np.ndarray, cap: int) -> float:
    """The most that a container can be worth, any number of items of each length."""
    best = np.zeros(cap + 1)
    order = np.argsort(sizes)
    sizes, values = sizes[order], values[order]
    able = np.searchsorted(sizes, np.arange(cap + 1), "right")
    for c in range(int(sizes[0]) if len(sizes) else cap + 1, cap + 1):
        k = able[c]
        best[c] = max(best[c - 1], (best[c - sizes[:k]] + values[:k]).max())
    return float(best[cap])


def solve_program(sizes: np.ndarray, counts: np.ndarray, cap: int, eta: float = ETA, rate: float = 2.0, priced: int = PRICED, bounds: int = 6, rest: float = REST) -> tuple[list[tuple[np.ndarray, np.ndarray, float]], np.ndarray, float]:
    """Configurations with fractional numbers of containers, what they leave, and a lower bound of the program.

    Stops where a share of ``rest`` of the total size is left, or every length
    has few items (under 2 / share). A step prices ``priced`` lengths; the bound comes from full pricing of all, ``bounds``
    times on the way and at the prices of the sizes themselves.
    """
    eta = min(0.5, eta * max(1.0, len(sizes) / STEPS_FOR))
    left = counts.astype(float)
    used: dict[bytes, list] = {}
    tail = 2 / eta
    bound = float(sizes @ counts) * 1.0 / most_valuable(sizes, sizes.astype(float), cap) if len(sizes) else 0.0
    steps, ask = 0, 4
    whole = float(sizes @ counts)
    while len(on := np.flatnonzero(left >= tail)) and sizes @ left > rest * whole:
        share = left[on] / counts[on]
        if len(on) > priced:  # partial pricing: the lengths of most weight, with those that fill what they leave
            top = on[np.argsort(-share, kind="stable")[: priced // 2]]
            fit = np.minimum(np.searchsorted(sizes[on], cap - sizes[top], "right"), len(on)) - 1
            on = np.unique(np.concatenate([top, on[fit[fit >= 0]]]))
            share = left[on] / counts[on]
        weight = np.exp(rate * (share - share.mean()))  # the product of all updates, by how much of a length is used
        price = sizes[on] * (1 + 0.05 * weight / weight.max())
        got = knapsack(sizes[on], price, np.maximum(1, (left[on] * eta).astype(np.int64)), cap)
        have = got > 0
        times = float(np.min(left[on][have] * eta * (2 if have.sum() == 1 else 1) / got[have]))
        config = np.zeros(len(sizes), np.int32)
        config[on] = got
        left -= config * times
        used.setdefault(config.tobytes(), [config, 0.0])[1] += times
        steps += 1
        if steps == ask and bounds:  # at steps 4, 16, 64, ...
            every = sizes * (1 + 0.05 * np.exp(rate * (left / counts - (left / counts).mean())))
            bound = max(bound, float(every @ counts) / most_valuable(sizes, every, cap))
            ask, bounds = ask * 4, bounds - 1
    return [(c, c[c > 0], t) for c, t in used.values()], left, bound


def best_fit(sizes: np.ndarray, left: np.ndarray, cap: int) -> list[Config]:
    """Best fit, largest first, of ``left`` items of each length; containers with equal contents are one entry."""
    done: list[tuple[list[tuple[int, int]], int]] = []
    room: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}
    levels: list[int] = []

    def put(free: int, items: list[tuple[int, int]], times: int) -> None:
        if free < smallest:
            done.append((items, times))
            return
        if free not in room:
            bisect.insort(levels, free)
            room[free] = []
        room[free].append((items, times))

    todo = [int(i) for i in np.argsort(-sizes, kind="stable") if left[i] > 0]
    smallest = int(min((sizes[i] for i in todo), default=1))
    for i in todo:
        s, n = int(sizes[i]), int(left[i])
        while n:
            k = bisect.bisect_left(levels, s)
            if k < len(levels):
                free = levels[k]
                items, times = room[free].pop()
                if not room[free]:
                    del room[free], levels[k]
            else:
                free, items, times = cap, [], -(-n // (cap // s))
            per = free // s  # the container stays the best fit until no more go in
            if n < per:
                whole, part = 0, n
            else:
                whole, part = min(times, n // per), 0
                if whole < times and (n - whole * per):
                    part = min(n - whole * per, per)
            for each, many in ((per, whole), (part, 1 if part else 0)):
                if many:
                    put(free - each * s, [*items, (i, each)], many)
                    n -= each * many
                    times -= many
            if times and items:
                put(free, items, times)
    done += [x for group in room.values() for x in group]
    return [(np.array([i for i, _ in items]), np.array([k for _, k in items]), times) for items, times in done if items]


def plan_containers(sizes: np.ndarray, counts: np.ndarray, cap: int, **options) -> tuple[list[Config], float]:
    """Configurations in whole numbers of containers that hold every item, and the lower bound of their number.

    Where rounding loses more than the program gains (long containers, lengths
    with few items each), best fit of all items takes its place, so there are
    never more containers than with that.
    """
    fit = best_fit(sizes, counts, cap)
    solved, _, bound = solve_program(sizes, counts, cap, **options)
    left, plan = counts.astype(np.int64).copy(), []
    for config, per, times in solved:
        whole = int(times + 1e-9)
        if whole:
            which = np.flatnonzero(config)
            left[which] -= per.astype(np.int64) * whole
            plan.append((which, per, whole))
    plan += best_fit(sizes, left, cap)
    return (plan if sum(x[2] for x in plan) <= sum(x[2] for x in fit) else fit), bound


class Places:
    """Rank within a length -> container, as arrays of ranges for each length."""

    def __init__(self, n: int, plan: list[Config], first: int = 0):
        self.start = [[0] for _ in range(n)]
        self.base: list[list[int]] = [[] for _ in range(n)]
        self.per: list[list[int]] = [[] for _ in range(n)]
        at = first
        for which, per, times in plan:
            for i, k in zip(which.tolist(), per.tolist()):
                self.base[i].append(at)
                self.per[i].append(k)
                self.start[i].append(self.start[i][-1] + k * times)
            at += times
        self.total = at
        self.start = [np.array(x) for x in self.start]
        self.base = [np.array(x, np.int64) for x in self.base]
        self.per = [np.array(x, np.int64) for x in self.per]

    def container(self, i: int, rank: np.ndarray) -> np.ndarray:
        k = np.searchsorted(self.start[i], rank, "right") - 1
        return self.base[i][k] + (rank - self.start[i][k]) // self.per[i][k]


def token_counts(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", pattern: str = PATTERN) -> DataFrame:
    """(id, tokens) of each text under the byte-pair vocabulary in the file ``vocabulary`` (ranks, base 64), words parted by ``pattern``; null counts 0."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            n = [len(enc.encode_ordinary(x)) if x else 0 for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["id", "tokens"])

    return df.select(id_col, text_col).mapInArrow(run, f"id {kind}, tokens bigint")


PACKED = "spec_id int, id {}, piece int, first_token bigint, tokens bigint, container bigint"


def plans(tokens: DataFrame, specs: list[tuple[int, int, int]]) -> DataFrame:
    """(spec_id, lengths, places, containers, bound) of each spec with items, a task each: the plan over the histogram of (id, tokens)."""
    rows = _per_spec(tokens, specs)
    hist = rows.groupBy("spec_id", "cap", F.col("c").alias("c")).agg(F.count("*").alias("m"), F.sum("full").alias("full"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        cap = int(pdf["cap"].iloc[0])
        some = pdf[pdf["c"] > 0].sort_values("c")
        sizes, counts = some["c"].to_numpy(np.int64), some["m"].to_numpy(np.int64)
        plan, bound = plan_containers(sizes, counts, cap)
        places = Places(len(sizes), plan)
        full = int(pdf["full"].sum())
        return pd.DataFrame({"spec_id": [int(pdf["spec_id"].iloc[0])], "plan": [pickle.dumps((sizes, places))], "containers": [places.total + full], "bound": [bound + full]})

    dealt = hist.repartition(8 * len(specs), "spec_id")  # small tables, but plans take time: they are not to share a task
    return dealt.groupBy("spec_id").applyInPandas(solve, "spec_id int, plan binary, containers bigint, bound double")


def _per_spec(tokens: DataFrame, specs: list[tuple[int, int, int]]) -> DataFrame:
    """Items with tokens under each spec: how many full containers, what is left, and its length with the gap (0 if nothing)."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("spec_id"), F.lit(c).alias("capacity"), F.lit(g).alias("gap")) for i, c, g in specs])).alias("s")
    rows = tokens.where("tokens > 0").select("id", "tokens", each).select("id", "tokens", "s.*")
    return rows.select(
        "spec_id", "id", "capacity", (F.col("capacity") + F.col("gap")).alias("cap"), F.expr("tokens div capacity").alias("full"), F.expr("tokens % capacity").alias("n"),
        F.expr("cast(case when tokens % capacity = 0 then 0 else tokens % capacity + gap end as int)").alias("c"),
    )


def pack(tokens: DataFrame, specs: list[tuple[int, int, int]], salts: int = 256) -> DataFrame:
    """(spec_id, id, piece, first_token, tokens, container) for (id, tokens) and specs (spec_id, capacity, gap).

    Items longer than the capacity are cut into full containers and a rest; no
    other item is split. Within a container the items' tokens and a gap between
    two of them never exceed the capacity. Items without tokens have no row.
    Repeated rows are items of their own. Specs are planned side by side.
    """
    spark = tokens.sparkSession
    kind = tokens.schema["id"].dataType.simpleString()
    if not specs:
        return spark.createDataFrame([], PACKED.format(kind))
    solved = {r.spec_id: (r.plan, r.containers) for r in plans(tokens, specs).collect()}  # bounded by lengths and configurations
    places = {k: pickle.loads(bytes(v[0])) for k, v in solved.items()}
    rows = _per_spec(tokens, specs).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    # ranks: counts of (length, salt) before, and the place within
    items = rows.where("n > 0")
    sums = items.groupBy("spec_id", "c", "salt").count()
    before = Window.partitionBy("spec_id", "c").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offset = sums.select("spec_id", "c", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("o"))
    place = F.row_number().over(Window.partitionBy("spec_id", "c", "salt").orderBy("id"))
    ranked = items.withColumn("r", place).join(offset, ["spec_id", "c", "salt"]).select("spec_id", "id", "full", "n", "c", "capacity", (F.col("o") + F.col("r") - 1).alias("rank"))

    def assign(batches):
        for batch in batches:
            spec, c, rank = (np.asarray(batch.column(i)).astype(np.int64) for i in (0, 4, 6))
            where = np.zeros(len(c), np.int64)
            key = spec << 32 | c
            for x in np.unique(key).tolist():
                hit = key == x
                sizes, where_of = places[x >> 32]
                where[hit] = where_of.container(int(np.searchsorted(sizes, x & 0xFFFFFFFF)), rank[hit])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(3), batch.column(5), pa.array(where)], ["spec_id", "id", "full", "n", "capacity", "container"])

    ends = ranked.mapInArrow(assign, f"spec_id int, id {kind}, full bigint, n bigint, capacity int, container bigint").select(
        "spec_id", "id", F.col("full").cast("int").alias("piece"), (F.col("full") * F.col("capacity")).alias("first_token"), F.col("n").alias("tokens"), "container"
    )
    # full pieces stand alone; their containers are numbered after the others by the same salted counts
    long = rows.where("full > 0")
    sums = long.groupBy("spec_id", "salt").agg(F.sum("full").alias("s"))
    before = Window.partitionBy("spec_id").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offset = sums.select("spec_id", "salt", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("o"))
    own = F.coalesce(F.sum("full").over(Window.partitionBy("spec_id", "salt").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = F.lit(0)
    for k, (_, where_of) in places.items():
        first = F.when(F.col("spec_id") == k, F.lit(where_of.total)).otherwise(first)
    numbered = long.withColumn("b", own).join(offset, ["spec_id", "salt"])
    full = numbered.select("spec_id", "id", "capacity", F.expr("explode(sequence(0L, full - 1))").alias("p"), (F.col("o") + F.col("b") + first).alias("base")).select(
        "spec_id", "id", F.col("p").cast("int").alias("piece"), (F.col("p") * F.col("capacity")).alias("first_token"), F.col("capacity").cast("bigint").alias("tokens"), (F.col("base") + F.col("p")).alias("container")
    )
    return ends.unionByName(full)


def fill_rates(packed: DataFrame, specs: DataFrame, solved: DataFrame) -> DataFrame:
    """Per spec: containers, tokens, gap tokens, fill rate (tokens and gaps of the room) and ``least_containers``, the dual bound of the program."""
    per = packed.groupBy("spec_id", "container").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("items"))
    s = specs.select("spec_id", "spec_name", "capacity_tokens", "gap_tokens").distinct()
    j = per.join(F.broadcast(s), "spec_id")
    rates = j.groupBy("spec_id", "spec_name", "capacity_tokens", "gap_tokens").agg(
        F.count("*").alias("containers"), F.sum("items").alias("pieces"), F.sum("tokens").alias("tokens"), F.max(F.expr("tokens + (items - 1) * gap_tokens")).alias("fullest"),
        (F.sum(F.expr("tokens + (items - 1) * gap_tokens")) / (F.count("*") * F.first("capacity_tokens"))).alias("fill_rate"),
    )
    return rates.join(solved.select("spec_id", F.ceil(F.col("bound") - 1e-6).alias("least_containers")), "spec_id")


def document_tokens(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tokens) of texts, made once and written to the shared folder."""
    return written(token_counts(df, vocabulary, id_col, text_col), "pack-tokens")


def spec_rows(specs: DataFrame) -> list[tuple[int, int, int]]:
    """The specs (a small table) as (spec_id, capacity, gap)."""
    return [(r.spec_id, r.capacity_tokens, r.gap_tokens) for r in specs.select("spec_id", "capacity_tokens", "gap_tokens").distinct().orderBy("spec_id").collect()]
