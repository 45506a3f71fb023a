"""Point-in-time feature table (operator 13): what was known of a client at the time t of each of their sales.

Everything that counts at t is a change log of its client: a click, sale or line enters when it has both happened and
arrived, and expires when its window of d days has passed it. A log is summed up in time order, so that a feature at t is
one look-up of the last entry not after t, less the same for expiry. The latest click is the running maximum of
(time, id) over the clicks that have entered, valid if it still lies in the window; the label looks forward to the next
sale. An item counts once however many lines hold it: intervals of (client, item) are cut so that none overlaps an earlier one, by
the greatest end before each.

Logs are cut into time slices, so that no client goes through one task. Sums of slices, a row for each client and slice,
give each slice its opening balance (and the next sale after it). The slices are dealt to buckets, in which pandas'
merge_asof finds for each sale its place in each log; balance and running sum are then joined on the sale's row. Slices
get shorter until the fullest holds at most SLICE_ROWS; results do not depend on them. The shortest are of 30 seconds,
so that what one client does within that time goes through one task.

Entries of one client at one instant are added up before they are dealt (a sale with a third of all lines has one entry
for each of its shipping times). The join of lines and sales has no further aggregate above it in its stage, so
that Spark splits a sale with many lines.

Defined results: times are read as UTC, whatever the session's zone; sales without client, time or sale_id have no t and give no
row, and those without sale_id count as sales all the same; repeated rows of sales count each (and repeat the lines), of lines too,
of clicks once if all columns agree; without arrived_at nothing is known of a row, so that it never counts, but a sale is a
label all the same; a value that is null or not finite is 0 cents; of equally late clicks one without an id comes last;
empty tables give no rows or zeros; further columns are read for the equality of clicks only.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varaq.llm.common import discard, materialise, table

DAY = 86_400_000_000
WINDOWS = (2, 14)
LABEL_DAYS = 7
ARRIVAL_US = 240 * 60_000_000
DELAY_SECONDS = 259_200
#: Lengths of a time slice, tried in turn; rows that a slice may hold; rows of a bucket.
SLICES = (2 * DAY, DAY // 8, DAY // 144, 30_000_000)
SLICE_ROWS = 150_000
BUCKET_ROWS = 100_000
NO_ID = -(2**63)

#: Kinds of logs and the sums that each carries; those of _COVER have entries of their own for each window.
_SUMS = {"click": ("n_clicks", "n_purchases", "click_cents"), "sale": ("n_sales", "sale_cents"), "line": ("n_lines", "line_cents"), "item": ("n_items",)}
_COVER = ("item",)
_FEATURES = ("n_clicks", "n_purchases", "click_cents", "last_click_id", "n_sales", "sale_cents", "n_lines", "n_items", "line_cents")
_RESULT = "sale_id bigint, d int, t_us bigint, label boolean, " + ", ".join(f"{c} bigint" for c in _FEATURES)
_LOG = ("client", "log", "at", "v0", "v1", "v2", "ts", "click_id")


def _logs(windows: tuple[int, ...]) -> dict[tuple[str, int], int]:
    """(name, window) -> number; window 0 stands for all."""
    names = []
    for kind in _SUMS:
        names += [(f"{kind}+", d) for d in (windows if kind in _COVER else (0,))] + [(f"{kind}-", d) for d in windows]
    return {name: k for k, name in enumerate([*names, ("next", 0), ("ask", 0)])}


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970; a time without a zone is UTC, whatever the session's zone is."""
    if dict(df.dtypes)[name] == "timestamp":
        return F.unix_micros(name)
    return F.expr(f"cast(cast(`{name}` - timestamp_ntz'1970-01-01 00:00:00' as decimal(20, 6)) * 1000000 as bigint)")


def cents(name: str) -> Column:
    x = F.col(name).cast("double")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 9e16)
    return F.when(finite, F.floor(100 * x + 0.5)).otherwise(0).cast("bigint")


def _known_sales(sales: DataFrame) -> DataFrame:
    s = sales.select(
        F.col("sale_id").cast("bigint").alias("sale_id"), F.col("client_id").cast("bigint").alias("client"), cents("total").alias("cents"), micros(sales, "sold_at").alias("sold"), micros(sales, "arrived_at").alias("came")
    )
    s = s.where("client is not null and sold is not null")
    return s.withColumn("entry", F.when(F.col("came").isNotNull(), F.greatest("sold", F.col("came") + ARRIVAL_US)))


def _changes(df: DataFrame, logs: list[tuple[int, Column, tuple[Column, ...]]], ts: Column | None = None, click_id: Column | None = None) -> DataFrame:
    """Rows of _LOG from the columns of df: each log is (number, at, sums)."""
    zero = F.lit(0).cast("bigint")

    def one(log, at, sums):
        v = [*sums, zero, zero, zero][:3]
        return F.struct(F.lit(log).alias("log"), at.alias("at"), *(x.cast("bigint").alias(f"v{k}") for k, x in enumerate(v)))

    keep = [(ts if ts is not None else zero).alias("ts"), (click_id if click_id is not None else zero).alias("click_id")]
    return df.select("client", *keep, F.explode(F.array(*(one(*x) for x in logs))).alias("c")).select("client", "c.*", "ts", "click_id").select(*_LOG)


def _entry_and_expiry(kind: str, number: dict, windows, entry: str, since: str, sums: tuple[Column, ...]) -> list:
    """Enters at `entry`; expires d days after `since`, or at once if it entered later than that."""
    enter = [(number[f"{kind}+", 0], F.col(entry), sums)]
    return enter + [(number[f"{kind}-", d], F.greatest(F.col(entry), F.col(since) + d * DAY), sums) for d in windows]


def click_logs(clicks: DataFrame, windows, number) -> DataFrame:
    c = clicks.distinct()
    c = c.select(F.col("client_id").cast("bigint").alias("client"), micros(c, "ts").alias("t"), (micros(c, "arrived_at") + ARRIVAL_US).alias("known"), (F.col("kind") == "purchase").cast("bigint").alias("p"), cents("value").alias("cents"), F.coalesce(F.col("click_id").cast("bigint"), F.lit(NO_ID)).alias("click_id"))
    c = c.where("client is not null and t is not null and known is not null").withColumn("entry", F.greatest("t", "known"))
    sums = F.lit(1), F.coalesce("p", F.lit(0)), F.col("cents")
    return _changes(c, _entry_and_expiry("click", number, windows, "entry", "t", sums), F.col("t"), F.col("click_id"))


def sale_logs(sales: DataFrame, windows, number) -> DataFrame:
    s = _known_sales(sales)
    known = _changes(s.where("entry is not null"), _entry_and_expiry("sale", number, windows, "entry", "sold", (F.lit(1), F.col("cents"))))
    t = F.col("sold") + 1_000_000 * (F.crc32(F.col("sale_id").cast("string")) % DELAY_SECONDS)
    asked = _changes(s.where("sale_id is not null"), [(number["ask", 0], t, (F.col("sale_id"),))])
    return known.unionByName(_changes(s, [(number["next", 0], F.col("sold"), ())])).unionByName(asked)


def known_lines(sales: DataFrame, lines: DataFrame, windows) -> DataFrame:
    """client, item, sold, entry, cents of the lines that count at some time."""
    got = lines.select(F.col("sale_id").cast("bigint").alias("sale_id"), F.col("item_id").cast("bigint").alias("item"), micros(lines, "shipped_at").alias("shipped"), cents("amount").alias("cents"))
    got = got.where("sale_id is not null and shipped is not null")
    s = _known_sales(sales).where("entry is not null and sale_id is not null").select("sale_id", "client", "sold", F.col("entry").alias("from"))
    j = got.join(s, "sale_id").withColumn("entry", F.greatest("from", "shipped"))
    return j.where(F.col("entry") < F.col("sold") + max(windows) * DAY).select("client", "item", "sold", "entry", "cents")


def _slice(at: Column, width: int) -> Column:
    return F.call_function("div", at - F.pmod(at, F.lit(width).cast("bigint")), F.lit(width).cast("bigint"))


def covered(lines: DataFrame, windows, width: int) -> DataFrame:
    """client, d, start, stop: for each item of a client, intervals without overlap in which some line counts."""
    one = lines.where("item is not null").groupBy("client", "item", "sold").agg(F.min("entry").alias("s"))
    one = one.select("client", "item", "s", F.explode(F.array(*(F.struct(F.lit(d).alias("d"), (F.col("sold") + d * DAY).alias("e")) for d in windows))).alias("w"))
    one = one.select("client", "item", "w.d", "s", "w.e").where("s < e").withColumn("slice", _slice(F.col("s"), width))
    key = ["client", "item", "d"]
    before = Window.partitionBy(*key, "slice").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    opening = one.groupBy(*key, "slice").agg(F.max("e").alias("e"))
    opening = opening.select(*key, "slice", F.max("e").over(Window.partitionBy(*key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)).alias("opening"))
    cut = one.withColumn("before", F.max("e").over(before)).join(opening, [*key, "slice"])
    return cut.select("client", "d", F.greatest("s", "before", "opening").alias("start"), F.col("e").alias("stop")).where("start < stop")


def line_logs(sales: DataFrame, lines: DataFrame, windows, number, width: int) -> DataFrame:
    """Entries of one client at one instant are one row."""
    known = materialise(known_lines(sales, lines, windows), "lines")
    out = _changes(known, _entry_and_expiry("line", number, windows, "entry", "sold", (F.lit(1), F.col("cents"))))
    pieces = covered(known, windows, width)
    for d in windows:
        ends = [(number["item+", d], F.col("start"), (F.lit(1),)), (number["item-", d], F.col("stop"), (F.lit(1),))]
        out = out.unionByName(_changes(pieces.where(F.col("d") == d), ends))
    summed = out.groupBy("client", "log", "at").agg(*(F.sum(f"v{k}").alias(f"v{k}") for k in range(3)))
    return summed.select("client", "log", "at", "v0", "v1", "v2", F.lit(0).cast("bigint").alias("ts"), F.lit(0).cast("bigint").alias("click_id"))


def _net(feature: str, d: int) -> str:
    return f"{feature}_{d}"


def slice_sums(logs: DataFrame, windows, number) -> DataFrame:
    """A row for each client and slice: what it adds to each feature, its latest click, first sale, rows and sales."""
    of = lambda name, d: F.col("log") == number[name, d]
    sums = []
    for kind, features in _SUMS.items():
        for k, feature in enumerate(features):
            for d in windows:
                entry = of(f"{kind}+", d if kind in _COVER else 0)
                sums.append(F.sum(F.when(entry, F.col(f"v{k}")).when(of(f"{kind}-", d), -F.col(f"v{k}")).otherwise(0)).alias(_net(feature, d)))
    # time and id as one number, whose maximum needs no sorting
    pair = F.expr(f"cast(ts as decimal(20,0)) * 18446744073709551616BD + click_id + {2**63}BD").cast("decimal(38,0)")
    return logs.groupBy("client", "slice").agg(
        *sums,
        F.max(F.when(of("click+", 0), pair)).alias("latest"),
        F.min(F.when(of("next", 0), F.col("at"))).alias("next"),
        F.count("*").alias("rows"),
        F.count_if(of("ask", 0)).alias("asked"),
    )


def opening_balances(sums: DataFrame, windows) -> DataFrame:
    """For each slice in which a sale asks: the sums of the client's earlier slices, the latest click in them (last_ts and
    last_id, NO_ID for none), and the first sale of later ones (NO_ID for none)."""
    before = Window.partitionBy("client").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("client").orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    nets = [_net(feature, d) for features in _SUMS.values() for feature in features for d in windows]
    out = sums.select("client", "slice", "asked", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in nets), F.max("latest").over(before).alias("latest"), F.min("next").over(after).alias("next"))
    two64 = "18446744073709551616BD"
    ts = F.expr(f"cast(latest div {two64} as bigint)")
    out = out.where("asked > 0").withColumn("last_ts", ts)
    last = F.expr(f"cast(latest - cast(last_ts as decimal(20,0)) * {two64} - {2**63}BD as bigint)")
    return out.select("client", "slice", *nets, F.coalesce("last_ts", F.lit(NO_ID)).alias("last_ts"), F.coalesce(last, F.lit(NO_ID)).alias("last_id"), F.coalesce("next", F.lit(NO_ID)).alias("next"))


def _looker(windows: tuple[int, ...], number: dict):
    """Of a bucket's logs and opening balances: the features of each sale that asks."""

    def place(asks: pd.DataFrame, log: pd.DataFrame, forward: bool = False) -> np.ndarray:
        """For each sale the row of the log that holds at its time, -1 for none."""
        right = pd.DataFrame({"at": log["at"].to_numpy(), "g": log["g"].to_numpy(), "i": np.arange(len(log))})
        found = pd.merge_asof(asks[["at", "g"]], right, on="at", by="g", direction="forward" if forward else "backward", allow_exact_matches=not forward)
        return found["i"].fillna(-1).to_numpy().astype(np.int64)

    def look(logs: pd.DataFrame, opening: pd.DataFrame) -> pd.DataFrame:
        both = pd.concat([opening[["client", "slice"]], logs[["client", "slice"]]], ignore_index=True)
        group = both.groupby(["client", "slice"], sort=False).ngroup().to_numpy()
        n = len(opening)  # the groups of the opening balances are 0 to n - 1
        logs = logs.assign(g=group[n:])
        logs = logs[logs["g"] < n].sort_values("at", kind="stable")
        part = {name: logs[logs["log"] == k] for name, k in number.items()}
        asks = part["ask", 0].reset_index(drop=True)
        g, t = asks["g"].to_numpy(), asks["at"].to_numpy()

        def running(name: tuple[str, int], sums: int) -> np.ndarray:
            log = part[name]
            if not len(log):
                return np.zeros((len(asks), sums), np.int64)
            total = log.groupby("g")[[f"v{k}" for k in range(sums)]].cumsum().to_numpy(np.int64)
            i = place(asks, log)
            return np.where((i >= 0)[:, None], total[i], 0)

        def latest() -> tuple[np.ndarray, np.ndarray]:
            ts, ids = opening["last_ts"].to_numpy()[g], opening["last_id"].to_numpy()[g]
            log = part["click+", 0]
            if len(log):
                log_ts, log_id = log["ts"].to_numpy(), log["click_id"].to_numpy()
                order = np.lexsort((log_id, log_ts))
                rank = np.empty(len(log), np.int64)
                rank[order] = np.arange(len(log))
                best = order[pd.Series(rank).groupby(log["g"].to_numpy()).cummax().to_numpy()]
                i = place(asks, log)
                row = best[i]
                newer = (i >= 0) & ((log_ts[row] > ts) | ((log_ts[row] == ts) & (log_id[row] > ids)))
                ts, ids = np.where(newer, log_ts[row], ts), np.where(newer, log_id[row], ids)
            return ts, ids

        following = opening["next"].to_numpy()[g]
        if len(part["next", 0]):
            i = place(asks, part["next", 0], forward=True)
            following = np.where(i >= 0, part["next", 0]["at"].to_numpy()[i], following)
        label = (following != NO_ID) & (following <= t + LABEL_DAYS * DAY)
        ts, ids = latest()
        entered = {kind: running((f"{kind}+", 0), len(f)) for kind, f in _SUMS.items() if kind not in _COVER}
        out = []
        for d in windows:
            rows = {"sale_id": asks["v0"].to_numpy(), "d": np.full(len(asks), d, np.int32), "t_us": t, "label": label}
            for kind, features in _SUMS.items():
                net = (running((f"{kind}+", d), len(features)) if kind in _COVER else entered[kind]) - running((f"{kind}-", d), len(features))
                for k, feature in enumerate(features):
                    rows[feature] = opening[_net(feature, d)].to_numpy()[g] + net[:, k]
            there = (ts > t - d * DAY) & (ids != NO_ID)
            rows["last_click_id"] = pd.array(np.where(there, ids, 0), dtype="Int64")
            rows["last_click_id"][~there] = pd.NA
            out.append(pd.DataFrame(rows)[["sale_id", "d", "t_us", "label", *_FEATURES]])
        return pd.concat(out, ignore_index=True)

    return look


def features(sales: DataFrame, clicks: DataFrame, lines: DataFrame, windows: tuple[int, ...] = WINDOWS, slices: tuple[int, ...] = SLICES, slice_rows: int = SLICE_ROWS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """sale_id, d, t_us, label and the features of each sale and window of d days."""
    number = _logs(windows)
    logs = click_logs(clicks, windows, number).unionByName(sale_logs(sales, windows, number)).unionByName(line_logs(sales, lines, windows, number, slices[0]))
    logs = materialise(logs, "logs")
    for k, width in enumerate(slices):
        cut = logs.withColumn("slice", _slice(F.col("at"), width))
        sums = materialise(slice_sums(cut, windows, number), "sums")
        fullest, total = sums.agg(F.max("rows"), F.sum("rows")).first()
        if (fullest or 0) <= slice_rows or k == len(slices) - 1:
            break
        discard(sums)
    buckets = -(-(total or 1) // bucket_rows)
    bucket = F.pmod(F.xxhash64("client", "slice"), F.lit(buckets)).alias("bucket")
    dealt = cut.select(bucket, "client", "slice", *_LOG[1:])
    opening = opening_balances(sums, windows).select(bucket, "*")
    return dealt.groupBy("bucket").cogroup(opening.groupBy("bucket")).applyInPandas(_looker(windows, number), _RESULT)


def op13_point_in_time(spark, sf_dir: str) -> DataFrame:
    return features(*(table(spark, sf_dir, t) for t in ("sales", "clicks", "sale_lines")))


OP13_SQL = f"""
    WITH s AS MATERIALIZED (
      SELECT row_number() OVER () AS r, sale_id, client_id, epoch_us(sold_at) AS sold, epoch_us(arrived_at) + {ARRIVAL_US} AS known, coalesce(floor(100 * total + 0.5), 0)::BIGINT AS cents
      FROM sales WHERE client_id IS NOT NULL AND sold_at IS NOT NULL
    ), crc AS (
      SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(sale_id::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) AS crc FROM s WHERE sale_id IS NOT NULL
    ), asked AS (
      SELECT r, sale_id, client_id, sold + 1000000 * (crc % {DELAY_SECONDS}) AS t, d, d * {DAY} AS width FROM crc, (VALUES {", ".join(f"({d})" for d in WINDOWS)}) w(d)
    ), c AS (
      SELECT client_id, click_id, kind, epoch_us(ts) AS ts, epoch_us(arrived_at) + {ARRIVAL_US} AS known, coalesce(floor(100 * value + 0.5), 0)::BIGINT AS cents FROM (SELECT DISTINCT * FROM clicks)
    ), clicked AS (
      SELECT r, d, count(*) AS n_clicks, count(*) FILTER (kind = 'purchase') AS n_purchases, sum(cents)::BIGINT AS click_cents, last(click_id ORDER BY ts, click_id NULLS FIRST) AS last_click_id
      FROM asked a JOIN c ON c.client_id = a.client_id AND c.ts > a.t - a.width AND c.ts <= a.t AND c.known <= a.t GROUP BY r, d
    ), bought AS (
      SELECT a.r, a.d, a.t, s.sale_id, s.cents FROM asked a JOIN s ON s.client_id = a.client_id AND s.sold > a.t - a.width AND s.sold <= a.t AND s.known <= a.t
    ), sold AS (SELECT r, d, count(*) AS n_sales, sum(cents)::BIGINT AS sale_cents FROM bought GROUP BY r, d), lined AS (
      SELECT r, d, count(*) AS n_lines, count(DISTINCT item_id) AS n_items, sum(coalesce(floor(100 * amount + 0.5), 0))::BIGINT AS line_cents
      FROM bought b JOIN sale_lines l ON l.sale_id = b.sale_id AND epoch_us(l.shipped_at) <= b.t GROUP BY r, d
    ), later AS (
      SELECT DISTINCT a.r FROM asked a JOIN s ON s.client_id = a.client_id AND s.sold > a.t AND s.sold <= a.t + {LABEL_DAYS * DAY}
    )
    SELECT a.sale_id, a.d::INT AS d, a.t AS t_us, later.r IS NOT NULL AS label, coalesce(n_clicks, 0) AS n_clicks, coalesce(n_purchases, 0) AS n_purchases, coalesce(click_cents, 0) AS click_cents,
      last_click_id, coalesce(n_sales, 0) AS n_sales, coalesce(sale_cents, 0) AS sale_cents, coalesce(n_lines, 0) AS n_lines, coalesce(n_items, 0) AS n_items, coalesce(line_cents, 0) AS line_cents
    FROM asked a LEFT JOIN clicked USING (r, d) LEFT JOIN sold USING (r, d) LEFT JOIN lined USING (r, d) LEFT JOIN later ON later.r = a.r
"""
