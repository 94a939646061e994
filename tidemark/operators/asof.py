"""As-of enrichment of trades with the latest info of their symbol.

Semantics (one rule for batch and stream):

* A trade sees the info with the greatest ``info_timestamp <= trade_timestamp``
  of its symbol; on equal ms the info comes first (total order ``(ms, ord, seq)``,
  info ``ord=0``, trade ``ord=1``).
* Of two infos with the same ms the first by ``seq`` wins; infos with
  ``info_timestamp <= 0`` are ignored.
* The whole info record is carried (record level); ``forward_fill`` is the
  column-level variant.

The "latest info so far" is a running ``max`` of a struct whose leading fields
are ``(info_ms, -seq)``, so newest-wins and first-of-equals fall out of struct
ordering and the running max is associative: it can be computed per time
bucket and combined, which is what makes the bucketed plan skew-safe.

Plans
-----
``bucket=None``: one window ``partitionBy(symbol)``. One exchange, one sort,
but a hot symbol is a single task.

``bucket='auto'`` (default) picks the plain plan where the largest symbol's share of the
inputs' size, as Catalyst estimates it, is at most 64 MB, and the bucketed plan above that.
Inputs of at most 64 MB need no look at their symbols; larger ones have their rows counted by
symbol, combined map-side.

``bucket='1 hour'`` (without ``ttl``), four exchanges, the trades in one of them:
1. the distinct (symbol, ``floor(ms / w)``) of the trades, a map-side-combined aggregate;
2. each (symbol, bucket)'s last info, another, over infos only;
3. a running max over these bucket rows carries the info across buckets (per
   symbol at most span/w rows twice, whatever the event count); what a bucket
   starts with becomes a row of that bucket, its seed;
4. trades, infos and seeds meet by (symbol, bucket), and one window per such
   group takes the running max. A hot symbol is as many groups as it has buckets;
   a narrower bucket makes smaller ones.

With ``ttl``:
0. trades are reduced to distinct (symbol, ms) - every trade of a symbol at
   one ms sees the same info - with a map-side-combined aggregate;
1. those times and the infos are keyed by ``(symbol, floor(ms / w))``; a hash
   aggregate gives each bucket's extent, a map-side-combined aggregate over
   infos only gives its last info;
2. a running max over that *bucket* table carries the info and the session's
   start across buckets;
3. the seed is equi-joined back on (symbol, bucket) and the in-bucket running
   max is taken over ``partitionBy(symbol, bucket)``;
4. the answers are equi-joined to the trades on (symbol, ms).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import default_missing, trade_value
from ..functions.time import interval_ms
from ..schemas import INFO_FIELDS

_MIN_LONG = -(2**63)

# bucket="auto": inputs of which no symbol holds more than this many bytes of the estimated
# size use the plain per-symbol window (one task can sort a symbol); others use the
# skew-safe bucketed plan.
AUTO_PLAIN_MAX_BYTES = 64 * 1024 * 1024
AUTO_BUCKET = "10 minutes"


def estimated_bytes(*dfs: DataFrame) -> int:
    """Catalyst's size estimate of the inputs (file sizes for scans; no job runs)."""
    total = 0
    for df in dfs:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        total += int(size) if isinstance(size, int) else int(size.toString())
    return total


def choose_bucket(trades: DataFrame, info: DataFrame, bucket):
    if bucket != "auto":
        return bucket
    return _auto_bucket([trades, info], ["symbol"])


def _auto_bucket(dfs: list[DataFrame], by: list[str]) -> str | None:
    size = estimated_bytes(*dfs)
    if size <= AUTO_PLAIN_MAX_BYTES:
        return None
    rows = dfs[0].select(*by)
    for df in dfs[1:]:
        rows = rows.unionByName(df.select(*by))
    largest, total = rows.groupBy(*by).count().agg(F.max("count"), F.sum("count")).first()
    return None if not total or size * largest <= AUTO_PLAIN_MAX_BYTES * total else AUTO_BUCKET


def info_key_struct(info: DataFrame, seq: str = "seq") -> Column:
    """struct(k_ms, k_nseq, company, sector, market_cap, info_timestamp): orderable newest-first."""
    return F.struct(
        F.col("info_timestamp").alias("k_ms"),
        (-F.col(seq)).alias("k_nseq"),
        *[F.col(c).alias(c) for c in INFO_FIELDS],
    )


def _valid_info(info: DataFrame) -> DataFrame:
    # An info with a non-positive (or missing) timestamp is never used. A NULL
    # symbol equals nothing, as in a join: such infos serve no trade in any plan.
    return info.where((F.col("info_timestamp") > 0) & F.col("symbol").isNotNull())


def union_for_asof(trades: DataFrame, info: DataFrame, seq: str = "seq",
                   seed: DataFrame | None = None) -> DataFrame:
    """Trades and infos as one stream ordered by ``(_ms, _ord, _seq)``.

    ``seed`` rows (a carried ``latest_info`` state) are placed ahead of every
    event of the batch (``_ms`` = Long.MIN, or their own ``at_ms``) but keep their
    real key inside the struct, so any newer in-batch info still wins.
    """
    t = trades.select(
        *[F.col(c) for c in trades.columns],
        F.col("trade_timestamp").alias("_ms"),
        F.lit(1).alias("_ord"),
        F.col(seq).alias("_seq"),
    )
    vi = _valid_info(info)
    parts = [vi.select(
        "symbol",
        F.col("info_timestamp").alias("_ms"),
        F.lit(0).alias("_ord"),
        F.col(seq).alias("_seq"),
        info_key_struct(vi, seq).alias("_info"),
    )]
    if seed is not None:
        vs = _valid_info(seed)
        parts.append(vs.select(
            "symbol",
            (F.col("at_ms") if "at_ms" in seed.columns else F.lit(_MIN_LONG).cast("bigint")).alias("_ms"),
            F.lit(0).alias("_ord"),
            F.col(seq).alias("_seq"),
            info_key_struct(vs, seq).alias("_info"),
            F.lit(True).alias("_carried"),
        ))
    out = t
    for p in parts:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def _project(trades: DataFrame, trade_cols: list[str], cur: Column, missing: str) -> DataFrame:
    out = trades.select(*trade_cols, *[cur[c].alias(c) for c in INFO_FIELDS])
    out = default_missing(out, missing)
    return out.withColumn("trade_value", trade_value())


def _finish(rows: DataFrame, trade_cols: list[str], cur: Column, missing: str) -> DataFrame:
    return _project(rows.where(F.col("_ord") == 1), trade_cols, cur, missing)


def enrich_asof(trades: DataFrame, info: DataFrame, *, missing: str = "sentinel",
                bucket: str | int | None = "auto", ttl: str | int | None = None,
                seq: str = "seq", seed: DataFrame | None = None) -> DataFrame:
    """Left-outer as-of join of every trade to its symbol's latest info.

    ``missing``: ``'sentinel'`` (UNKNOWN/UNKNOWN/0/0) or ``'null'``.
    ``bucket``: time-bucket width for the skew-safe plan, None for a plain
    per-symbol window, or ``'auto'`` (default): plain when the largest symbol's share of the
    inputs' estimated size is at most ``AUTO_PLAIN_MAX_BYTES``, else ``AUTO_BUCKET``.
    ``ttl``: a gap longer than this between consecutive events of a symbol
    starts a new session that carries no info (the 24 h expiry rule).
    ``seed``: carried state from earlier batches (``latest_info`` output). With
    ``ttl`` it says in ``at_ms`` when its symbol's last event before this batch
    was (not after the batch's first), so that a gap before the batch counts too.

    NULL keys, the same in every plan: a trade with a NULL symbol or a NULL
    timestamp matches no info; an info with either is never used.
    """
    trade_cols = list(trades.columns)
    bucket = choose_bucket(trades, info, bucket)
    u = union_for_asof(trades, info, seq, seed)
    order = [F.col("_ms"), F.col("_ord"), F.col("_seq")]
    upto_here = (Window.unboundedPreceding, Window.currentRow)

    if ttl is None and bucket is None:
        w = Window.partitionBy("symbol").orderBy(*order).rowsBetween(*upto_here)
        return _finish(u.withColumn("_cur", F.max("_info").over(w)), trade_cols, F.col("_cur"), missing)

    if ttl is None:
        return _bucketed(trades, info, interval_ms(bucket), trade_cols, missing, seq, seed)
    # With width <= ttl no in-bucket gap can exceed the ttl, so a session can
    # only start at a bucket's first event and is decided on the bucket table.
    ttl_ms = interval_ms(ttl)
    width = min(interval_ms(bucket), ttl_ms) if bucket is not None else ttl_ms
    # 0. All trades of a symbol at one ms see the same info: solve the as-of once
    #    per distinct (symbol, ms) - map-side combined - and join the answers back.
    times = (trades.select("symbol", "trade_timestamp").distinct()
             .withColumn(seq, F.lit(0).cast("bigint")))
    answers = _bucketed_answers(union_for_asof(times, info, seq, seed), width, ttl_ms)
    joined = trades.join(answers, ["symbol", "trade_timestamp"], "left")
    return _project(joined, trade_cols, F.col("_cur"), missing)


def _bucketed(trades: DataFrame, info: DataFrame, width: int, trade_cols: list[str], missing: str, seq: str,
              seed: DataFrame | None) -> DataFrame:
    """The bucketed plan without sessions (see the module docstring)."""
    known = F.col("symbol").isNotNull() & F.col("trade_timestamp").isNotNull()
    u = union_for_asof(trades.where(known), info, seq, seed)
    u = u.withColumn("_b", F.floor(F.col("_ms") / F.lit(width)))
    infos = u.where(F.col("_ord") == 0)
    last = infos.groupBy("symbol", "_b").agg(F.max("_info").alias("_info"))
    wanted = (trades.where(known)
              .select("symbol", F.floor(F.col("trade_timestamp") / F.lit(width)).alias("_b")).distinct())
    before = (Window.partitionBy("symbol").orderBy("_b", "_wanted")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # of one bucket the wanted row comes first: it takes what earlier buckets have left
    carried = (wanted.withColumn("_wanted", F.lit(0))
               .unionByName(last.withColumn("_wanted", F.lit(1)), allowMissingColumns=True)
               .withColumn("_info", F.max("_info").over(before)))
    seeds = carried.where((F.col("_wanted") == 0) & F.col("_info").isNotNull()).select(
        "symbol", "_b", F.lit(_MIN_LONG).cast("bigint").alias("_ms"), F.lit(0).alias("_ord"),
        F.lit(0).cast("bigint").alias("_seq"), "_info")
    in_bucket = (Window.partitionBy("symbol", "_b").orderBy("_ms", "_ord", "_seq")
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = u.unionByName(seeds, allowMissingColumns=True).withColumn("_cur", F.max("_info").over(in_bucket))
    found = _finish(rows, trade_cols, F.col("_cur"), missing)
    # a trade without a symbol or a time matches nothing and is not shuffled
    none = trades.where(~known).withColumn("_cur", F.lit(None).cast(infos.schema["_info"].dataType))
    return found.unionByName(_project(none, trade_cols, F.col("_cur"), missing))


def _bucketed_answers(u: DataFrame, width: int, ttl_ms: int | None) -> DataFrame:
    """(symbol, trade_timestamp, _cur) for every trade time in ``u``."""
    order = [F.col("_ms"), F.col("_ord"), F.col("_seq")]
    # The explicit not-null filter equals what the inner join below would infer,
    # so both uses of ``u`` are the same plan and Spark reuses its exchange.
    u = u.withColumn("_b", F.floor(F.col("_ms") / F.lit(width)))
    u = u.where(F.col("symbol").isNotNull() & F.col("_b").isNotNull())

    # 1. per (symbol, bucket): the event-time extent over all events (a hash
    #    aggregate) and the last info, whose struct max needs a sort-based
    #    aggregate but reads infos only.
    extent = u.groupBy("symbol", "_b").agg(
        F.min(F.when(F.col("_ms") > _MIN_LONG, F.col("_ms"))).alias("_bmin"),
        F.max("_ms").alias("_bmax"),
    )
    last_info = (u.where(F.col("_ord") == 0).groupBy("symbol", "_b")
                 .agg(F.max("_info").alias("_blast")))
    bk = extent.join(last_info, ["symbol", "_b"], "left")
    # 2. carry across buckets on the small bucket table.
    wb = Window.partitionBy("symbol").orderBy("_b")
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    seed_col = F.max("_blast").over(before)
    cols = [F.col("symbol"), F.col("_b"), seed_col.alias("_seed")]
    if ttl_ms is not None:
        if "_carried" in u.columns:
            carried = u.where("_carried").select("symbol", "_b", "_carried")
            bk = bk.join(carried, ["symbol", "_b"], "left")
        bk = bk.withColumn("_bstart", _session_start(before, ttl_ms, "_carried" in u.columns))
        cols.append(F.max("_bstart").over(wb.rowsBetween(Window.unboundedPreceding, Window.currentRow))
                    .alias("_sstart"))
    seeds = bk.select(*cols)
    if ttl_ms is not None:
        # A carried info older than the current session start has expired.
        seeds = seeds.select(
            "symbol", "_b",
            F.when(F.col("_seed.k_ms") >= F.coalesce(F.col("_sstart"), F.lit(_MIN_LONG)), F.col("_seed"))
            .alias("_seed"),
        )
    # 3. in-bucket running max over distinct trade times and infos (a group is
    #    bounded by the bucket width in ms, not by the trade count), plus the seed.
    wi = Window.partitionBy("symbol", "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding,
                                                                        Window.currentRow)
    j = u.join(seeds, ["symbol", "_b"], "inner")
    j = j.withColumn("_cur", F.greatest(F.col("_seed"), F.max("_info").over(wi)))
    return j.where(F.col("_ord") == 1).select("symbol", F.col("_ms").alias("trade_timestamp"), "_cur")


def _session_start(before, ttl_ms: int, carried: bool):
    """On the bucket table: the bucket's first event if a session starts there, that is, if no
    event of the symbol lies before it (a carried one goes on) or the last too long ago."""
    prev_max = F.max("_bmax").over(before)
    first = prev_max.isNull() | (prev_max == _MIN_LONG)
    if carried:
        first = first & F.col("_carried").isNull()
    return F.when(first | (F.col("_bmin") - prev_max > ttl_ms), F.col("_bmin"))


def carry_sessions(trades: DataFrame, info: DataFrame, ttl: str | int, seed: DataFrame | None = None,
                   seq: str = "seq") -> DataFrame:
    """What each symbol of a batch carries on under ``ttl`` (E6): ``latest_info`` columns, NULL
    where its last session has had no info, and ``last_ms``, its newest event.

    ``seed``: the same from earlier batches, with ``at_ms`` as in ``enrich_asof``. Sessions are
    told on a table of one row per symbol and ttl-wide bucket."""
    ttl_ms = interval_ms(ttl)
    valid = _valid_info(info)
    times = (trades.select("symbol", F.col("trade_timestamp").alias("_ms"))
             .unionByName(valid.select("symbol", F.col("info_timestamp").alias("_ms")))
             .where(F.col("symbol").isNotNull() & F.col("_ms").isNotNull()))
    extent = (times.groupBy("symbol", F.floor(F.col("_ms") / F.lit(ttl_ms)).alias("_b"))
              .agg(F.min("_ms").alias("_bmin"), F.max("_ms").alias("_bmax"))
              .withColumn("_carried", F.lit(None).cast("boolean")))
    if seed is not None:
        held = seed.select("symbol", F.floor(F.col("at_ms") / F.lit(ttl_ms)).alias("_b"), F.col("at_ms").alias("_bmin"),
                           F.col("at_ms").alias("_bmax"), F.lit(True).alias("_carried"))
        extent = extent.unionByName(held).groupBy("symbol", "_b").agg(
            F.min("_bmin").alias("_bmin"), F.max("_bmax").alias("_bmax"), F.max("_carried").alias("_carried"))
    before = Window.partitionBy("symbol").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    last = (extent.withColumn("_start", _session_start(before, ttl_ms, True)).groupBy("symbol")
            .agg(F.max("_start").alias("_start"), F.max("_bmax").alias("last_ms")))
    known = valid.select("symbol", *INFO_FIELDS, seq).join(last, "symbol").where(
        F.col("_start").isNull() | (F.col("info_timestamp") >= F.col("_start")))
    if seed is not None:
        old = seed.withColumnRenamed("last_ms", "_last")
        last = (last.join(old.select("symbol", "_last"), "symbol", "left")
                .withColumn("last_ms", F.greatest("last_ms", "_last")).drop("_last"))
        known = known.unionByName(_valid_info(seed).select("symbol", *INFO_FIELDS, seq)
                                  .join(last.where("_start IS NULL"), "symbol"))
    return last.join(latest_info(known, seq), "symbol", "left").select("symbol", *INFO_FIELDS, seq, "last_ms")


def latest_info(info: DataFrame, seq: str = "seq", seed: DataFrame | None = None) -> DataFrame:
    """Newest info per symbol; of equal timestamps the first by ``seq``.

    A hash aggregate with map-side partial max, so a hot symbol is combined
    before the shuffle. ``seed`` merges a previously carried state.
    """
    src = _valid_info(info).select("symbol", *INFO_FIELDS, seq)
    if seed is not None:
        src = src.unionByName(_valid_info(seed).select("symbol", *INFO_FIELDS, seq))
    best = src.groupBy("symbol").agg(F.max(info_key_struct(src, seq)).alias("_m"))
    return best.select(
        "symbol",
        *[F.col("_m")[c].alias(c) for c in INFO_FIELDS],
        (-F.col("_m.k_nseq")).alias(seq),
    )


def forward_fill(df: DataFrame, cols: list[str], by: list[str], order: list[str], *,
                 bucket_on: str | None = None, bucket: str | int | None = None) -> DataFrame:
    """Column-level last-observation-carried-forward.

    Each of ``cols`` takes its last non-null value over ``partitionBy(by)``
    ordered by ``order``. With ``bucket_on`` (an epoch-ms column that is the
    first ``order`` key) and ``bucket`` the same two-level plan as
    ``enrich_asof`` is used, so a hot key is split across tasks;
    ``bucket='auto'`` uses the plain window where the largest key's share
    of the estimated size is at most ``AUTO_PLAIN_MAX_BYTES``. Rows with a NULL in ``by`` or in the first ``order``
    key belong to no series, in every plan: they keep their own values and
    fill no other row.
    """
    known = _all_not_null([*by, order[0]])
    okeys = [F.col(c) for c in order]
    upto_here = (Window.unboundedPreceding, Window.currentRow)
    if bucket == "auto":
        bucket = _auto_bucket([df], by)
        bucket_on = bucket_on if bucket else None
    if bucket_on is None:
        w = Window.partitionBy(*by).orderBy(*okeys).rowsBetween(*upto_here)
        return df.withColumns({
            c: F.when(known, F.last(F.when(known, F.col(c)), ignorenulls=True).over(w)).otherwise(F.col(c))
            for c in cols})

    width = interval_ms(bucket)
    d = df.withColumn("_b", F.floor(F.col(bucket_on) / F.lit(width)))
    known = F.col("_b").isNotNull() & known
    nulls = d.where(~known)
    d = d.where(known)  # same plan for both uses below
    # Last non-null per (key, bucket) for each column: max of struct(order..., value).
    tagged = {c: F.when(F.col(c).isNotNull(), F.struct(*okeys, F.col(c).alias("v"))) for c in cols}
    bk = d.groupBy(*by, "_b").agg(*[F.max(e).alias(f"_l_{c}") for c, e in tagged.items()])
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    seeds = bk.select(*by, "_b", *[F.max(f"_l_{c}").over(before)["v"].alias(f"_s_{c}") for c in cols])
    wi = Window.partitionBy(*by, "_b").orderBy(*okeys).rowsBetween(*upto_here)
    j = d.join(seeds, [*by, "_b"], "inner")
    j = j.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(wi), F.col(f"_s_{c}")) for c in cols})
    return j.drop("_b", *[f"_s_{c}" for c in cols]).unionByName(nulls.drop("_b"))


def _all_not_null(cols: list[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond
