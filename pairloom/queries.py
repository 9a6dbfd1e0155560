"""Queries over the driver's tables, by name, each with SQL that computes the same independently."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.decay import DISTANCE_WEIGHTS, TIME_WEIGHTS, DistanceDecay, TimeDecay, WidgetContext
from pairloom.operators import diagnostics, eda
from pairloom.operators.aggregate import aggregate_window, aggregate_window_from_daily
from pairloom.operators.bitmaps import FULL, aggregate_window_from_sets, daily_sets, user_codes
from pairloom.operators.cleaning import clean_events
from pairloom.operators.evaluation import TemporalSplit, coverage, fallback_hits, ground_truth, item_metrics, mean_metrics, offline_metrics, popularity_bias, ranking_truth, source_shares, split_train_validation
from pairloom.operators.fallback import FallbackSettings, candidate_pools, merge_fallback
from pairloom.operators.pairs import DailyPairStats, PairSettings, daily_pair_stats, item_pairs, pair_counts, raw_pair_rows, session_items
from pairloom.operators.popularity import action_distribution, action_shares, item_popularity
from pairloom.operators.scoring import Scorer
from pairloom.operators.sessions import build_sessions, build_sessions_by_day, build_sessions_of_all
from pairloom.operators.topk import TopK
from pairloom.output.writers import combined, enriched, lookup_lists
from pairloom.plans.layout import aggregates_in_buckets, clean_in_buckets
from pairloom.plans.parts import DailyParts
from pairloom.schemas import ACTIONS, RAW_COUNTS, WEIGHTED_COUNTS
from pairloom.sources.adapters import basket_events, products, raw_event_stream, raw_events
from pairloom.sources.events import counted_from_footers
from pairloom.sources.files import shared_path, staged
from pairloom.streaming.carry_over import STATE_STORE, carried_sessions, sessions_through

START, END = "2024-01-01", "2024-01-30"
TRAIN_UNTIL, VALID_FROM = "2024-01-20", "2024-01-21"
#: A day's timeout makes enough pairs of the small event table.
TIMEOUT = 1440
SHARES = {"view": 0.5, "click": 0.2, "favorite": 0.15, "to_cart": 0.15}
WIDGETS = WidgetContext(enabled=True, weights={"product_detailed_page": 1.5, "search_catalog_listing": 0.5})
FALLBACK = FallbackSettings(enabled=True, top_k=10, enable_brand=True)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

# ---- the oracle's common tables -------------------------------------------------------------------------------

_CTE = {
    "raw": """SELECT CAST(user_id AS BIGINT) user_id, CAST(ts AS DATE) AS date, ts AS timestamp,
        CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'click' WHEN 'signup' THEN 'favorite' WHEN 'purchase' THEN 'to_cart' WHEN 'error' THEN 'search' END action_type,
        CASE WHEN value >= 10 THEN 'product_detailed_page' ELSE 'search_catalog_listing' END widget_name, CAST(NULL AS VARCHAR) search_query, CAST(json_extract_string(props, '$.k') AS BIGINT) item_id FROM events""",
    "clean": """SELECT DISTINCT user_id, CAST(timestamp AS DATE) event_date, timestamp, action_type, item_id, search_query, coalesce(widget_name, 'unknown') widget_name FROM raw
        WHERE user_id IS NOT NULL AND timestamp IS NOT NULL AND item_id IS NOT NULL AND action_type IN ('view', 'click', 'favorite', 'to_cart')""",
    "marked": """SELECT *, CASE WHEN g IS NULL OR g > {timeout} * 60 THEN 1 ELSE 0 END n FROM (SELECT *, date_sub('second', lag(timestamp) OVER (PARTITION BY user_id ORDER BY timestamp, item_id, action_type), timestamp) g FROM {cleaned})""",
    "indexed": "SELECT *, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY timestamp, item_id, action_type ROWS UNBOUNDED PRECEDING) AS BIGINT) session_index FROM marked",
    "sessions": "SELECT user_id, session_index, min(event_date) OVER (PARTITION BY user_id, session_index) session_start_date, event_date, timestamp, action_type, item_id, widget_name FROM indexed",
    "placed": "SELECT *, row_number() OVER (PARTITION BY user_id, session_index ORDER BY timestamp, item_id, action_type, widget_name) pos, CASE action_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'favorite' THEN 3 WHEN 'to_cart' THEN 4 ELSE 0 END pri FROM sessions",
    "collapsed": """SELECT user_id, session_index, session_start_date, item_id, first(action_type ORDER BY pri DESC, pos) item_action_type, first(widget_name ORDER BY pri DESC, pos) item_widget_name, max(pri) signal_priority, min(pos) event_position
        FROM placed GROUP BY ALL""",
    "items": "SELECT * FROM collapsed QUALIFY count(*) OVER (PARTITION BY user_id, session_index) BETWEEN 2 AND 50",
    "pairs": """SELECT s.session_start_date pair_date, s.item_id, t.item_id similar_item_id, s.user_id, s.session_index, s.item_action_type source_action_type, t.item_action_type target_action_type,
        s.item_widget_name source_widget_name, t.item_widget_name target_widget_name, t.item_action_type signal_type, s.event_position source_event_position, t.event_position target_event_position,
        abs(t.event_position - s.event_position) position_distance, {distance} distance_weight, {widget} widget_weight, ({distance}) * ({widget}) graph_weight
        FROM items s JOIN items t ON s.user_id = t.user_id AND s.session_index = t.session_index AND s.item_id <> t.item_id""",
    "agg": """SELECT item_id, similar_item_id, {counts}, count(DISTINCT user_id) unique_users, count(DISTINCT (user_id, session_index)) unique_sessions, '{start}' window_start, '{end}' window_end
        FROM (SELECT *, graph_weight * ({time}) w FROM pairs WHERE pair_date BETWEEN DATE '{start}' AND DATE '{end}') GROUP BY 1, 2""",
    "pop": "SELECT item_id, {pop} FROM {popped} GROUP BY 1",
    "prod": "SELECT CAST(p_partkey AS BIGINT) item_id, p_name AS name, p_brand AS brand, p_type AS type, CAST(p_size AS BIGINT) category_id, 'size_' || p_size category_name FROM part",
    "scored": "SELECT item_id, similar_item_id, CAST(pair_count AS DOUBLE) score, {rawcols}, {weightedcols}, unique_users, unique_sessions FROM agg",
    "top": "SELECT item_id, similar_item_id, score, rank, 'behavioral' source, {rawcols}, {weightedcols}, unique_users, unique_sessions FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, similar_item_id) rank FROM scored) WHERE rank <= {k}",
    "vtruth": """SELECT item_id, similar_item_id relevant_item_id, {relevance} relevance, CASE WHEN to_cart_count > 0 THEN 'to_cart' WHEN favorite_count > 0 THEN 'favorite' WHEN click_count > 0 THEN 'click' ELSE 'view' END target_action_type,
        pair_count evidence_count, view_count, click_count, favorite_count, to_cart_count FROM (SELECT item_id, similar_item_id, {counts} FROM (SELECT *, graph_weight w FROM pairs WHERE pair_date BETWEEN DATE '2024-01-21' AND DATE '2024-01-30') GROUP BY 1, 2)""",
}
_ORDER = list(_CTE)


def _counts_sql(weight: str = "w") -> str:
    raw = ["count(*) pair_count", *(f"count(*) FILTER (signal_type = '{a}') {a}_count" for a in ACTIONS)]
    return ", ".join([*raw, f"round(sum({weight}), 6) weighted_pair_count", *(f"round(coalesce(sum({weight}) FILTER (signal_type = '{a}'), 0), 6) weighted_{a}_count" for a in ACTIONS)])


_POP = "count(*) events_count, count(DISTINCT user_id) unique_users, count(*) FILTER (action_type = 'view') views_count, count(*) FILTER (action_type = 'click') clicks_count, count(*) FILTER (action_type = 'favorite') favorites_count, count(*) FILTER (action_type = 'to_cart') to_cart_count"


def _sql(body: str, upto: str, also: tuple[str, ...] = (), timeout: int = TIMEOUT, distance: str = "1.0::DOUBLE", widget: str = "1.0::DOUBLE", time: str = "1.0::DOUBLE", start: str = START, end: str = END, k: int = 10, relevance: str = "1.0::DOUBLE", cleaned: str = "clean") -> str:
    """The common tables up to one, or those of ``also``, and a query over them."""
    slots = {"timeout": timeout, "distance": distance, "widget": widget, "time": time, "start": start, "end": end, "k": k, "relevance": relevance, "cleaned": cleaned, "counts": _counts_sql(), "pop": _POP, "popped": cleaned, "rawcols": ", ".join(RAW_COUNTS), "weightedcols": ", ".join(WEIGHTED_COUNTS)}
    chain = _ORDER[: _ORDER.index("agg") + 1] if upto in ("scored", "top") else _ORDER[: _ORDER.index(upto) + 1] if _ORDER.index(upto) <= _ORDER.index("agg") else _ORDER[:2]
    if upto in ("scored", "top"):
        chain = [*chain, "scored", *(["top"] if upto == "top" else [])]
    if "vtruth" in also and "pairs" not in chain:
        chain = _ORDER[: _ORDER.index("pairs") + 1]
    chain = [c for c in _ORDER if c in {*chain, *also}]
    return "WITH " + ", ".join(f"{c} AS ({_CTE[c].format(**slots)})" for c in chain) + " " + body


def _query(name: str, sql: str | None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of floats depend on their order beyond the sixth place."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


# ---- shared steps ---------------------------------------------------------------------------------------------


def _clean(spark: SparkSession, d: str) -> DataFrame:
    return clean_events(raw_events(spark, d))


def _sessions(spark: SparkSession, d: str) -> DataFrame:
    return build_sessions(_clean(spark, d), TIMEOUT)


def _pairs(spark: SparkSession, d: str, settings: PairSettings = PairSettings()) -> DataFrame:
    return item_pairs(_sessions(spark, d), settings)


def _aggregates(spark: SparkSession, d: str, end: str = END) -> DataFrame:
    return aggregate_window(_pairs(spark, d), START, end)


def _top(spark: SparkSession, d: str, k: int = 10, end: str = END) -> DataFrame:
    return TopK(top_k=k, deduplicate=False).select(Scorer(method="pair_count").score(_aggregates(spark, d, end)))


def _truth(spark: SparkSession, d: str, mode: str = "binary") -> DataFrame:
    counts = daily_pair_stats(_sessions(spark, d)).counts.filter(F.col("pair_date").between(F.lit(VALID_FROM).cast("date"), F.lit(END).cast("date")))
    return ground_truth(counts, mode)


# ---- cleaning, sessions, pairs --------------------------------------------------------------------------------

_query("clean_events", _sql("SELECT * FROM clean", "clean"))(_clean)
_query("sessions", _sql("SELECT * FROM sessions", "sessions", timeout=30))(lambda s, d: build_sessions(_clean(s, d), 30))
_query("sessions_day_timeout", _sql("SELECT * FROM sessions", "sessions"))(_sessions)
_query("sessions_by_day", _sql("SELECT * FROM sessions", "sessions"))(lambda s, d: build_sessions_by_day(_clean(s, d), TIMEOUT))
_query("session_items", _sql("SELECT * FROM items", "items"))(lambda s, d: session_items(_sessions(s, d)))
_query("session_items_in_ranges", _sql("SELECT * FROM items", "items"))(lambda s, d: session_items(_sessions(s, d), heavy_events=12))


def _bucketed(s: SparkSession, d: str) -> DataFrame:
    path = shared_path("buckets")
    return clean_in_buckets(raw_events(s, d), f"clean_{path[-32:]}", path, 16)


def _bucketed_top(s: SparkSession, d: str) -> DataFrame:
    path = shared_path("buckets")
    aggregates = aggregates_in_buckets(_aggregates(s, d), f"aggregates_{path[-32:]}", path, 16)
    return _rounded(TopK(top_k=10, deduplicate=False).select(Scorer(method="pair_count").score(aggregates)), "score", *WEIGHTED_COUNTS)


_query("sessions_bucketed", _sql("SELECT * FROM sessions", "sessions"))(lambda s, d: build_sessions(_bucketed(s, d), TIMEOUT))
_query("item_popularity_bucketed", _sql("SELECT * FROM pop", "clean", ("pop",)))(lambda s, d: item_popularity(_bucketed(s, d)))
_query("topk_bucketed", _sql("SELECT * FROM top", "top"))(_bucketed_top)
_query("item_pairs", _sql("SELECT * FROM pairs", "pairs"))(_pairs)
_query("item_pairs_30min", _sql("SELECT * FROM pairs", "pairs", timeout=30))(lambda s, d: item_pairs(build_sessions(_clean(s, d), 30)))
_BASKETS = """SELECT CAST(o_custkey AS BIGINT) user_id, CAST(o_orderdate AS DATE) AS date, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_minutes(CAST(l_linenumber AS BIGINT)) AS timestamp,
        CASE WHEN l_returnflag = 'A' THEN 'favorite' WHEN l_returnflag = 'R' THEN 'to_cart' WHEN l_linestatus = 'O' THEN 'view' ELSE 'click' END action_type,
        CASE WHEN l_linestatus = 'O' THEN 'search_catalog_listing' ELSE 'product_detailed_page' END widget_name, CAST(NULL AS VARCHAR) search_query, CAST(l_partkey AS BIGINT) item_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
_query("sessions_of_all", _sql("SELECT * FROM sessions", "sessions"))(lambda s, d: build_sessions_of_all(_clean(s, d), TIMEOUT, heavy_events=70))


def _streamed(s: SparkSession, d: str) -> DataFrame:
    """The event table as a stream: sessions that its micro-batches finish, and those that its state still holds."""
    s.conf.set(*STATE_STORE)
    out, state = shared_path("sessions"), shared_path("state")
    stream = carried_sessions(raw_event_stream(s, d), TIMEOUT).writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
    stream.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return sessions_through(s.read.parquet(out), s, state, str(_clean(s, d).agg(F.max("event_date")).first()[0]), TIMEOUT)


def _by_parts(s: SparkSession, d: str) -> DailyPairStats:
    """Daily tables of users in parts, one of which comes twice, compacted before the last."""
    parts, sessions = DailyParts(shared_path("parts")), staged(_sessions(s, d))
    for k in (2, 0, 2):
        parts.add(f"users-{k}", sessions.filter(F.pmod("user_id", F.lit(3)) == k))
    parts.compact()
    parts.add("users-1", sessions.filter(F.pmod("user_id", F.lit(3)) == 1))
    return parts.read()


_query("streamed_sessions", _sql("SELECT * FROM sessions", "sessions"))(_streamed)
_query("clean_string_timestamps", _sql("SELECT * FROM clean", "clean"))(lambda s, d: clean_events(raw_events(s, d).withColumn("timestamp", F.col("timestamp").cast("string"))))
_query("raw_pair_rows", _sql("SELECT pair_date, count(*) raw_pair_rows FROM pairs GROUP BY 1", "pairs"))(lambda s, d: raw_pair_rows(_pairs(s, d)))
_query("item_pairs_baskets", _sql("SELECT * FROM pairs", "pairs", timeout=30).replace(_CTE["raw"], _BASKETS))(lambda s, d: item_pairs(build_sessions(clean_events(basket_events(s, d)), 30)))
_query("max_distance", _sql("SELECT * FROM pairs WHERE position_distance <= 2", "pairs"))(lambda s, d: _pairs(s, d, PairSettings(distance_decay=DistanceDecay(enabled=True, max_distance=2))))

_TABLE = "CASE WHEN abs(t.event_position - s.event_position) > 5 THEN 0.1 WHEN abs(t.event_position - s.event_position) >= 5 THEN 0.3 WHEN abs(t.event_position - s.event_position) >= 3 THEN 0.6 WHEN abs(t.event_position - s.event_position) >= 2 THEN 0.8 ELSE 1.0 END"
_EXP = "greatest(exp(-0.5 * (abs(t.event_position - s.event_position) - 1)), 0.05)"
_WIDGET = "CASE t.item_widget_name WHEN 'product_detailed_page' THEN 1.5 WHEN 'search_catalog_listing' THEN 0.5 ELSE 1.0 END"
_PAIR_ROUND = "SELECT * REPLACE (round(distance_weight, 6) AS distance_weight, round(widget_weight, 6) AS widget_weight, round(graph_weight, 6) AS graph_weight) FROM pairs"
_WEIGHTS = ("distance_weight", "widget_weight", "graph_weight")
_query("distance_decay_table", _sql(_PAIR_ROUND, "pairs", distance=f"CAST({_TABLE} AS DOUBLE)"))(lambda s, d: _rounded(_pairs(s, d, PairSettings(distance_decay=DistanceDecay(True, "weight_table", table=DISTANCE_WEIGHTS))), *_WEIGHTS))
_query("distance_decay_exp", _sql(_PAIR_ROUND, "pairs", distance=_EXP))(lambda s, d: _rounded(_pairs(s, d, PairSettings(distance_decay=DistanceDecay(True, "exponential"))), *_WEIGHTS))
_SHORT = {1: 0.9, 2: 0.5}
_SHORT_SQL = "CASE WHEN abs(t.event_position - s.event_position) > 2 THEN 1.0 WHEN abs(t.event_position - s.event_position) = 2 THEN 0.5 ELSE 0.9 END"
_query("distance_decay_no_default", _sql(_PAIR_ROUND, "pairs", distance=f"CAST({_SHORT_SQL} AS DOUBLE)"))(lambda s, d: _rounded(_pairs(s, d, PairSettings(distance_decay=DistanceDecay(True, "weight_table", table=_SHORT))), *_WEIGHTS))
_query("widget_weight_source", _sql(_PAIR_ROUND, "pairs", widget=f"CAST({_WIDGET.replace('t.item', 's.item')} AS DOUBLE)"))(lambda s, d: _rounded(_pairs(s, d, PairSettings(widget_context=replace(WIDGETS, use="source"))), *_WEIGHTS))
_query("widget_weight", _sql(_PAIR_ROUND, "pairs", widget=f"CAST({_WIDGET} AS DOUBLE)"))(lambda s, d: _rounded(_pairs(s, d, PairSettings(widget_context=WIDGETS)), *_WEIGHTS))

_DAILY = "SELECT pair_date, item_id, similar_item_id, {more}{counts} FROM (SELECT *, graph_weight w FROM pairs) GROUP BY {by}"
_query("pair_counts", _sql(_DAILY.format(more="", counts=_counts_sql(), by="1, 2, 3"), "pairs"))(lambda s, d: _rounded(daily_pair_stats(_sessions(s, d)).counts, *WEIGHTED_COUNTS))
_query("widget_counts", _sql(_DAILY.format(more="target_widget_name, ", counts=_counts_sql(), by="1, 2, 3, 4"), "pairs"))(lambda s, d: _rounded(daily_pair_stats(_sessions(s, d)).widget_counts, *WEIGHTED_COUNTS))
_query("user_keys", _sql("SELECT DISTINCT pair_date, item_id, similar_item_id, user_id FROM pairs", "pairs"))(lambda s, d: daily_pair_stats(_sessions(s, d)).user_keys)
_query("session_keys", _sql("SELECT DISTINCT pair_date, item_id, similar_item_id, user_id, session_index FROM pairs", "pairs"))(lambda s, d: daily_pair_stats(_sessions(s, d)).session_keys)

_query("pair_counts_by_parts", _sql(_DAILY.format(more="", counts=_counts_sql(), by="1, 2, 3"), "pairs"))(lambda s, d: _rounded(_by_parts(s, d).counts, *WEIGHTED_COUNTS))
_query("session_keys_by_parts", _sql("SELECT DISTINCT pair_date, item_id, similar_item_id, user_id, session_index FROM pairs", "pairs"))(lambda s, d: _by_parts(s, d).session_keys)

# ---- aggregates -----------------------------------------------------------------------------------------------

_AGE = "date_diff('day', pair_date, DATE '2024-01-30')"
_TIME_TABLE = f"CAST(CASE WHEN {_AGE} > 14 THEN 0.2 WHEN {_AGE} >= 14 THEN 0.3 WHEN {_AGE} >= 7 THEN 0.5 WHEN {_AGE} >= 3 THEN 0.75 WHEN {_AGE} >= 1 THEN 0.9 ELSE 1.0 END AS DOUBLE)"
_TIME_EXP = f"greatest(exp(-ln(2) / 7 * {_AGE}), 0.05)"


def _from_daily(s: SparkSession, d: str) -> DataFrame:
    daily = daily_pair_stats(_sessions(s, d))
    return _rounded(aggregate_window_from_daily(daily.counts, daily.user_keys, daily.session_keys, START, END), *WEIGHTED_COUNTS)


_query("window_aggregate", _sql("SELECT * FROM agg", "agg"))(lambda s, d: _rounded(_aggregates(s, d), *WEIGHTED_COUNTS))
_query("window_aggregate_compact", _sql("SELECT * FROM agg", "agg"))(_from_daily)


def _from_sets(s: SparkSession, d: str, full: int) -> DataFrame:
    daily = daily_pair_stats(_sessions(s, d))
    sets = daily_sets(daily, user_codes(_clean(s, d)), full)
    return _rounded(aggregate_window_from_sets(sets, START, END), *WEIGHTED_COUNTS)


_query("window_aggregate_sets", _sql("SELECT * FROM agg", "agg"))(lambda s, d: _from_sets(s, d, FULL))
_query("window_aggregate_bitmaps", _sql("SELECT * FROM agg", "agg"))(lambda s, d: _from_sets(s, d, 2))
_query("time_decay_table", _sql("SELECT * FROM agg", "agg", time=_TIME_TABLE))(lambda s, d: _rounded(aggregate_window(_pairs(s, d), START, END, TimeDecay(True, "weight_table", TIME_WEIGHTS)), *WEIGHTED_COUNTS))
_query("time_decay_exp", _sql("SELECT * FROM agg", "agg", time=_TIME_EXP))(lambda s, d: _rounded(aggregate_window(_pairs(s, d), START, END, TimeDecay(True, "exponential")), *WEIGHTED_COUNTS))
_query("window_aggregate_weekly", _sql("SELECT * FROM agg", "agg", start="2024-01-08", end="2024-01-14"))(lambda s, d: _rounded(aggregate_window(_pairs(s, d), "2024-01-08", "2024-01-14"), *WEIGHTED_COUNTS))

_query("window_aggregate_bucket", _sql("SELECT * FROM agg WHERE item_id % 4 = 1", "agg"))(lambda s, d: (lambda t: _rounded(aggregate_window_from_daily(t.counts, t.user_keys, t.session_keys, START, END, item_bucket=(1, 4)), *WEIGHTED_COUNTS))(daily_pair_stats(_sessions(s, d))))
_LEGACY = ", ".join([*RAW_COUNTS, *(f"CAST({r} AS DOUBLE) {w}" for r, w in zip(RAW_COUNTS, WEIGHTED_COUNTS, strict=True))])
_query("window_aggregate_legacy", _sql(f"SELECT item_id, similar_item_id, {_LEGACY}, unique_users, unique_sessions, window_start, window_end FROM agg", "agg", widget=f"CAST({_WIDGET} AS DOUBLE)"))(
    lambda s, d: (lambda t: _rounded(aggregate_window_from_daily(t.counts.drop(*WEIGHTED_COUNTS), t.user_keys, t.session_keys, START, END), *WEIGHTED_COUNTS))(daily_pair_stats(_sessions(s, d), PairSettings(widget_context=WIDGETS)))
)
_query("pair_counts_without_weights", _sql(_DAILY.format(more="", counts=_counts_sql(), by="1, 2, 3"), "pairs"))(lambda s, d: _rounded(pair_counts(_pairs(s, d, PairSettings(widget_context=WIDGETS)).drop("distance_weight", "widget_weight", "graph_weight")), *WEIGHTED_COUNTS))

# ---- popularity -----------------------------------------------------------------------------------------------

_query("item_popularity", _sql("SELECT * FROM pop", "clean", ("pop",)))(lambda s, d: item_popularity(_clean(s, d)))
_query("item_popularity_by_date", _sql(f"SELECT event_date, item_id, {_POP} FROM clean GROUP BY 1, 2", "clean"))(lambda s, d: item_popularity(_clean(s, d), ["event_date"]))
_query("item_popularity_by_action", _sql("SELECT action_type, item_id, count(*) events_count, count(DISTINCT user_id) unique_users FROM clean GROUP BY 1, 2", "clean"))(lambda s, d: item_popularity(_clean(s, d), ["action_type"]))
_query("item_popularity_by_widget", _sql(f"SELECT widget_name, item_id, {_POP} FROM clean GROUP BY 1, 2", "clean"))(lambda s, d: item_popularity(_clean(s, d), ["widget_name"]))
_query("action_distribution", _sql(f"SELECT action_type, count(*) events_count, round(count(*) / sum(count(*)) OVER (), 9) event_share, count(DISTINCT user_id) unique_users, count(DISTINCT item_id) unique_items, '{START}' calibration_start, '{END}' calibration_end FROM clean GROUP BY 1", "clean"))(
    lambda s, d: action_distribution(_clean(s, d), START, END).withColumn("event_share", F.round("event_share", 9))
)

# ---- scores and lists -----------------------------------------------------------------------------------------


def _scored(scorer: Scorer) -> Callable[[SparkSession, str], DataFrame]:
    def f(s: SparkSession, d: str) -> DataFrame:
        popularity = item_popularity(_clean(s, d)) if scorer.normalize_by_popularity else None
        return _rounded(scorer.score(_aggregates(s, d), popularity), "score", *WEIGHTED_COUNTS)

    return f


def _score_sql(score: str, where: str = "true", also: tuple[str, ...] = (), join: str = "") -> str:
    columns = ", ".join(f"a.{c}" for c in (*RAW_COUNTS, *WEIGHTED_COUNTS, "unique_users", "unique_sessions"))
    return _sql(f"SELECT a.item_id, a.similar_item_id, round({score}, 6) score, {columns} FROM agg a {join} WHERE {where}", "agg", also)


_LOG = "1.0 * ln(view_count + 1.0) + 3.0 * ln(click_count + 1.0) + 6.0 * ln(favorite_count + 1.0) + 8.0 * ln(to_cart_count + 1.0)"
_BOOST = " + ".join(f"{w} * least(power(0.5 / {SHARES[a]}, 0.5), {cap}) * ln({a}_count + 1.0)" for a, w, cap in (("view", 1.0, 1.0), ("click", 3.0, 10.0), ("favorite", 6.0, 15.0), ("to_cart", 8.0, 30.0)))
_query("score_pair_count", _score_sql("CAST(pair_count AS DOUBLE)"))(_scored(Scorer(method="pair_count")))
_query("score_calibrated_log", _score_sql(_LOG))(_scored(Scorer()))
_query("score_calibrated_linear", _score_sql("CAST(view_count + 3 * click_count + 6 * favorite_count + 8 * to_cart_count AS DOUBLE)"))(_scored(Scorer(count_transform="linear")))
_query("score_calibrated_sqrt", _score_sql("sqrt(view_count) + 3 * sqrt(click_count) + 6 * sqrt(favorite_count) + 8 * sqrt(to_cart_count)"))(_scored(Scorer(count_transform="sqrt")))
_query("score_beta", _score_sql(_BOOST))(_scored(Scorer(action_shares=SHARES)))
_SHARED = " + ".join(f"{w} * least(power((SELECT n FROM shares WHERE action_type = 'view') / (SELECT n FROM shares WHERE action_type = '{a}'), 0.5), {cap}) * ln({a}_count + 1.0)" for a, w, cap in (("view", 1.0, 1.0), ("click", 3.0, 10.0), ("favorite", 6.0, 15.0), ("to_cart", 8.0, 30.0)))
_query("score_measured_shares", _score_sql(_SHARED).replace(" SELECT a.item_id", ", shares AS (SELECT action_type, count(*) n FROM clean GROUP BY 1) SELECT a.item_id", 1))(lambda s, d: _scored(Scorer(action_shares=action_shares(action_distribution(_clean(s, d), START, END))))(s, d))
_query("score_thresholds", _score_sql(_LOG, f"pair_count >= 2 AND unique_users >= 2 AND unique_sessions >= 2 AND weighted_pair_count >= 2.5 AND round({_LOG}, 6) >= 5"))(_scored(Scorer(min_pair_count=2, min_unique_users=2, min_unique_sessions=2, min_weighted_pair_count=2.5, min_score=5.0)))


def _pruned(s: SparkSession, d: str) -> DataFrame:
    scorer = Scorer(min_pair_count=2, min_unique_users=3, min_unique_sessions=2)
    sessions = _sessions(s, d).filter(F.col("session_start_date").between(F.lit(START).cast("date"), F.lit(END).cast("date")))
    return _rounded(scorer.score(aggregate_window(item_pairs(sessions, support=scorer.support()), START, END)), "score", *WEIGHTED_COUNTS)


_query("score_thresholds_pruned", _score_sql(_LOG, "pair_count >= 2 AND unique_users >= 3 AND unique_sessions >= 2"))(_pruned)
_query("score_weighted_source", _score_sql("weighted_view_count + 3 * weighted_click_count + 6 * weighted_favorite_count + 8 * weighted_to_cart_count"))(_scored(Scorer(count_source="weighted", count_transform="linear")))
_query("score_popularity_norm", _score_sql(f"({_LOG.replace('view_count', 'a.view_count').replace('click_count', 'a.click_count').replace('favorite_count', 'a.favorite_count').replace('to_cart_count', 'a.to_cart_count')}) / power((p.unique_users + 1.0) * (q.unique_users + 1.0), 0.5)", "true", ("pop",), "LEFT JOIN pop p ON p.item_id = a.item_id LEFT JOIN pop q ON q.item_id = a.similar_item_id"))(
    _scored(Scorer(normalize_by_popularity=True))
)
_query("topk", _sql("SELECT * FROM top", "top"))(lambda s, d: _rounded(_top(s, d), "score", *WEIGHTED_COUNTS))


def _dedup(s: SparkSession, d: str) -> DataFrame:
    scores = Scorer(method="pair_count").score(_aggregates(s, d))
    twice = scores.unionByName(scores.withColumn("score", F.col("score") * 2).filter("item_id % 2 = 0"))
    return TopK(top_k=5).select(twice).select("item_id", "similar_item_id", "score", "rank", "source")


_query("topk_dedup", _sql("""SELECT item_id, similar_item_id, score, rank, 'behavioral' source FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, similar_item_id) rank
    FROM (SELECT item_id, similar_item_id, max(score) score FROM (SELECT item_id, similar_item_id, score FROM scored UNION ALL SELECT item_id, similar_item_id, score * 2 FROM scored WHERE item_id % 2 = 0) GROUP BY 1, 2)) WHERE rank <= 5""", "scored"))(_dedup)  # fmt: skip

# ---- fallback -------------------------------------------------------------------------------------------------

_LEVEL_SQL = [("category_type", "CAST(category_id AS VARCHAR)", "type"), ("category", "CAST(category_id AS VARCHAR)", "''"), ("type", "type", "''"), ("brand", "brand", "''"), ("global", "''", "''")]
_ORDER_SQL = "unique_users DESC, to_cart_count DESC, favorites_count DESC, clicks_count DESC, views_count DESC, events_count DESC, item_id"
_POOLS = "SELECT level, k1, k2, item_id, place FROM (" + " UNION ALL ".join(f"SELECT '{level}' AS level, {a} k1, {b} k2, pop.item_id, row_number() OVER (PARTITION BY {a}, {b} ORDER BY {_ORDER_SQL.replace('item_id', 'pop.item_id')}) place FROM pop LEFT JOIN prod ON prod.item_id = pop.item_id WHERE {a} IS NOT NULL AND {b} IS NOT NULL" for level, a, b in _LEVEL_SQL) + ") WHERE place <= 11"
_query("fallback_pools", _sql(_POOLS, "clean", ("pop", "prod")))(lambda s, d: candidate_pools(item_popularity(_clean(s, d)), products(s, d), FALLBACK))


def _merged(s: SparkSession, d: str) -> DataFrame:
    short = _top(s, d, 3, TRAIN_UNTIL)
    return merge_fallback(short, item_popularity(_clean(s, d)), products(s, d), FALLBACK)


# every candidate of every level, without the pools' cut
_WALK = """, src AS (SELECT item_id FROM top UNION SELECT item_id FROM pop), cand AS (SELECT src.item_id, c.item_id similar_item_id, min(l.depth) depth FROM src LEFT JOIN prod sp ON sp.item_id = src.item_id
    CROSS JOIN (SELECT pop.*, prod.category_id, prod.type, prod.brand FROM pop LEFT JOIN prod ON prod.item_id = pop.item_id) c
    JOIN (VALUES (0), (1), (2), (3), (4)) l(depth) ON (l.depth = 0 AND c.category_id = sp.category_id AND c.type = sp.type) OR (l.depth = 1 AND c.category_id = sp.category_id) OR (l.depth = 2 AND c.type = sp.type) OR (l.depth = 3 AND c.brand = sp.brand) OR l.depth = 4
    WHERE src.item_id <> c.item_id GROUP BY 1, 2),
    filled AS (SELECT item_id, similar_item_id, score, source, 0 late, 0 depth, rank AS ord FROM top UNION ALL
      SELECT c.item_id, c.similar_item_id, 0.0, ['fallback_category_type_popular', 'fallback_category_popular', 'fallback_type_popular', 'fallback_brand_popular', 'fallback_global_popular'][c.depth + 1], 1, c.depth, row_number() OVER (ORDER BY """ + _ORDER_SQL.replace("item_id", "p.item_id").replace("unique_users", "p.unique_users") + """)
      FROM cand c JOIN pop p ON p.item_id = c.similar_item_id WHERE NOT EXISTS (SELECT 1 FROM top t WHERE t.item_id = c.item_id AND t.similar_item_id = c.similar_item_id)),
    merged AS (SELECT item_id, similar_item_id, score, source, row_number() OVER (PARTITION BY item_id ORDER BY late, depth, ord, similar_item_id) rank FROM filled QUALIFY rank <= 10)"""  # fmt: skip


def _walk(body: str, also: tuple[str, ...] = ()) -> str:
    sql = _sql("\0", "top", ("pop", "prod", *also), k=3, end=TRAIN_UNTIL)
    return sql.replace(" \0", _WALK + " " + body)


_query("fallback_merge", _walk("SELECT item_id, similar_item_id, score, rank, source FROM merged"))(lambda s, d: _merged(s, d).select("item_id", "similar_item_id", "score", "rank", "source"))
_query("source_distribution", _walk("SELECT source, count(*) AS rows FROM merged GROUP BY 1"))(lambda s, d: eda.source_distribution(_merged(s, d)))

# ---- outputs --------------------------------------------------------------------------------------------------

_query("lookup_arrays", _sql("SELECT item_id, list(similar_item_id ORDER BY rank, similar_item_id) similar_items_sku_list FROM top GROUP BY 1", "top"))(lambda s, d: lookup_lists(_top(s, d)))
_query("enriched", _sql("SELECT t.item_id, a.name item_name, t.similar_item_id, b.name similar_item_name, t.rank, t.score, t.source FROM top t LEFT JOIN prod a ON a.item_id = t.item_id LEFT JOIN prod b ON b.item_id = t.similar_item_id", "top", ("prod",)))(lambda s, d: enriched(_top(s, d), products(s, d)))
_query("preview_semi_join", _sql("SELECT item_id, similar_item_id, rank FROM top WHERE rank <= 5 AND item_id IN (SELECT DISTINCT item_id FROM top ORDER BY 1 LIMIT 20)", "top"))(lambda s, d: eda.preview(_top(s, d), 20, 5).select("item_id", "similar_item_id", "rank"))
_query("item_catalogue", _sql("SELECT t.item_id, count(*) similar_items, any_value(p.name) item_name FROM top t LEFT JOIN prod p ON p.item_id = t.item_id GROUP BY 1", "top", ("prod",)))(lambda s, d: eda.item_catalogue(_top(s, d), products(s, d)))

# ---- evaluation -----------------------------------------------------------------------------------------------

_GRADED = "round(0.1::DOUBLE * view_count + 0.3 * click_count + 0.6 * favorite_count + 1.0 * to_cart_count, 6)"
_query("ground_truth_binary", _sql("SELECT * FROM vtruth", "pairs", ("vtruth",)))(_truth)
_query("ground_truth_graded", _sql("SELECT * FROM vtruth", "pairs", ("vtruth",), relevance=_GRADED))(lambda s, d: _rounded(_truth(s, d, "graded"), "relevance"))
_SPLIT = TemporalSplit(TRAIN_UNTIL, VALID_FROM, END)


def _split(s: SparkSession, d: str) -> DataFrame:
    train, valid = split_train_validation(_clean(s, d), _SPLIT)
    both = train.withColumn("part", F.lit("train")).unionByName(valid.withColumn("part", F.lit("validation")))
    return both.groupBy("part", "event_date").agg(F.count("*").alias("events"))


_query("split", _sql(f"SELECT CASE WHEN event_date <= DATE '{TRAIN_UNTIL}' THEN 'train' ELSE 'validation' END part, event_date, count(*) events FROM clean WHERE event_date <= DATE '{END}' GROUP BY 1, 2", "clean"))(_split)

_HITS = """, tr{n} AS (SELECT * FROM vtruth WHERE {where}), tot{n} AS (SELECT item_id, sum(relevance) total, {totals} FROM tr{n} tr GROUP BY 1),
    hit{n} AS (SELECT tr.item_id, count(*) hits, sum(relevance) found, min(rank) fst, sum(relevance / log2(rank + 1)) dcg, {hits} FROM tr{n} tr JOIN {recs} r ON r.item_id = tr.item_id AND r.similar_item_id = tr.relevant_item_id AND r.rank <= 10 GROUP BY 1),
    ideal{n} AS (SELECT item_id, sum(relevance / log2(place + 1)) ideal FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY relevance DESC, relevant_item_id) place FROM tr{n}) WHERE place <= 10 GROUP BY 1),
    per{n} AS (SELECT tot.item_id, CASE WHEN coalesce(hits, 0) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END hit, coalesce(found / nullif(total, 0), 0) recall, coalesce(1.0 / fst, 0) mrr, coalesce(dcg / nullif(ideal, 0), 0) ndcg, {per}
      FROM tot{n} tot LEFT JOIN hit{n} hit ON hit.item_id = tot.item_id LEFT JOIN ideal{n} ideal ON ideal.item_id = tot.item_id)"""
_METRIC_NAMES = ["hit", "recall", "mrr", "ndcg", *(f"{a}_{n}" for a in ACTIONS for n in ("hit", "recall"))]


def _slice_sql(where: str = "true", recs: str = "top", n: str = "") -> str:
    return _HITS.format(
        n=n, where=where, recs=recs, totals=", ".join(f"count(*) FILTER (tr.{a}_count > 0) {a}_total" for a in ACTIONS), hits=", ".join(f"count(*) FILTER (tr.{a}_count > 0) {a}_hits" for a in ACTIONS),
        per=", ".join(f"CASE WHEN {a}_total > 0 THEN CASE WHEN coalesce({a}_hits, 0) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END {a}_hit, CASE WHEN {a}_total > 0 THEN coalesce({a}_hits, 0) / {a}_total END {a}_recall" for a in ACTIONS),
    )


def _metrics_sql(body: str, where: str = "true", recs: str = "top", relevance: str = "1.0::DOUBLE", walk: bool = False, more: str | None = None) -> str:
    more = more or _slice_sql(where, recs)
    sql = _sql("\0", "top", ("vtruth", *(("pop", "prod") if walk else ())), k=3 if walk else 10, end=TRAIN_UNTIL, relevance=relevance)
    return sql.replace(" \0", (_WALK if walk else "") + more + " " + body)


_MEANS = "SELECT " + ", ".join(f"round(avg({c}), 6) {c}" for c in _METRIC_NAMES) + ", count(*) AS items FROM per"
_STRONG = "target_action_type IN ('click', 'favorite', 'to_cart') OR (target_action_type <> 'view' AND relevance >= 0.3)"


def _means(df: DataFrame) -> DataFrame:
    return _rounded(df, *_METRIC_NAMES)


def _recs(s: SparkSession, d: str) -> DataFrame:
    return _top(s, d, 10, TRAIN_UNTIL)


_query("metrics_ranking", _metrics_sql(_MEANS, _STRONG, relevance=_GRADED))(lambda s, d: _means(mean_metrics(_recs(s, d), ranking_truth(_rounded(_truth(s, d, "graded"), "relevance")), 10)))
_query("metrics_action", _metrics_sql(_MEANS))(lambda s, d: _means(mean_metrics(_recs(s, d), _truth(s, d), 10)))
_query("metrics_to_cart", _metrics_sql(_MEANS, "to_cart_count > 0"))(lambda s, d: _means(mean_metrics(_recs(s, d), _truth(s, d).filter("to_cart_count > 0"), 10)))
_query("item_metrics", _metrics_sql("SELECT item_id, " + ", ".join(f"round({c}, 6) {c}" for c in _METRIC_NAMES) + " FROM per"))(lambda s, d: _means(item_metrics(_recs(s, d), _truth(s, d), 10)))
_query("metrics_fallback_share", _walk("SELECT " + ", ".join(f"round(avg(CASE WHEN {c} THEN 1.0 ELSE 0.0 END), 6) {n}" for n, c in [("fallback_share", "source <> 'behavioral'"), *((f"fallback_{level}_share", f"source = 'fallback_{level}_popular'") for level, _, _ in _LEVEL_SQL)]) + " FROM merged WHERE rank <= 10"))(
    lambda s, d: (lambda df: _rounded(df, *df.columns))(source_shares(_merged(s, d), 10))
)
_query("metrics_fallback_hits", _metrics_sql("SELECT round(avg(hit), 6) fallback_hit_rate, round(avg(recall), 6) fallback_recall FROM per", recs="(SELECT * FROM merged WHERE source <> 'behavioral')", walk=True))(
    lambda s, d: _rounded(fallback_hits(_merged(s, d), _truth(s, d), 10), "fallback_hit_rate", "fallback_recall")
)
_query("metrics_popularity_bias", _sql("SELECT round(avg(p.unique_users) / (SELECT max(unique_users) FROM pop), 6) popularity_bias FROM top t JOIN pop p ON p.item_id = t.similar_item_id", "top", ("pop",)))(lambda s, d: _rounded(popularity_bias(_top(s, d), item_popularity(_clean(s, d)), 10), "popularity_bias"))
_query("metrics_coverage", _sql("SELECT round(avg(CASE WHEN item_id IN (SELECT item_id FROM top) THEN 1.0 ELSE 0.0 END), 6) coverage, count(*) FILTER (item_id IN (SELECT item_id FROM top)) covered, count(*) AS items FROM (SELECT DISTINCT item_id FROM vtruth)", "top", ("vtruth",), end=TRAIN_UNTIL))(lambda s, d: _rounded(coverage(_recs(s, d), _truth(s, d)), "coverage"))

_LATE = "(SELECT * FROM merged WHERE source <> 'behavioral')"
_SLICES = {"_r": (_STRONG, "merged"), "_f": ("true", "merged"), "_c": ("to_cart_count > 0", "merged"), "_rl": (_STRONG, _LATE), "_cl": ("to_cart_count > 0", _LATE)}
_FIELDS = {
    **{f"{p}{n}_at_k": f"(SELECT avg({c}) FROM per_r)" for p in ("", "strong_") for n, c in (("hit_rate", "hit"), ("recall", "recall"), ("ndcg", "ndcg"), ("mrr", "mrr"))},
    **{f"to_cart_{c}_at_k": f"(SELECT avg({c}) FROM per_c)" for c in ("mrr", "ndcg")},
    "coverage_at_k": "(SELECT avg(CASE WHEN item_id IN (SELECT item_id FROM merged) THEN 1.0 ELSE 0.0 END) FROM tot_r)",
    "popularity_bias_at_k": "(SELECT avg(p.unique_users) / (SELECT max(unique_users) FROM pop) FROM merged m JOIN pop p ON p.item_id = m.similar_item_id)",
    "fallback_share_at_k": "(SELECT avg(CASE WHEN source <> 'behavioral' THEN 1.0 ELSE 0.0 END) FROM merged)",
    **{f"fallback_{level}_share_at_k": f"(SELECT avg(CASE WHEN source = 'fallback_{level}_popular' THEN 1.0 ELSE 0.0 END) FROM merged)" for level, _, _ in _LEVEL_SQL},
    **{f"fallback_{p}{n}_at_k": f"(SELECT avg({c}) FROM per{t})" for p, t in (("", "_rl"), ("to_cart_", "_cl")) for n, c in (("hit_rate", "hit"), ("recall", "recall"))},
    **{f"{a}_{n}_at_k": f"(SELECT avg({a}_{c}) FROM per_f)" for a in ACTIONS for n, c in (("hit_rate", "hit"), ("recall", "recall"))},
}
_COUNTED = {
    **{n: "(SELECT count(*) FROM tot_r)" for n in ("evaluated_items", "ranking_evaluated_items")},
    "recommended_items": "(SELECT count(*) FROM tot_r WHERE item_id IN (SELECT item_id FROM merged))",
    "ground_truth_pairs": "(SELECT count(*) FROM tr_f)",
    "all_evaluated_items": "(SELECT count(*) FROM tot_f)",
    "view_only_ground_truth_pairs": "(SELECT count(*) FROM tr_f WHERE view_count > 0 AND click_count <= 0 AND favorite_count <= 0 AND to_cart_count <= 0)",
    "ranking_ground_truth_pairs": "(SELECT count(*) FROM tr_r)",
}


def _offline(s: SparkSession, d: str) -> DataFrame:
    truth = _rounded(_truth(s, d, "graded"), "relevance")
    found = offline_metrics(staged(_merged(s, d)), staged(truth), 10, item_popularity(_clean(s, d))).as_dict()
    one = s.createDataFrame([tuple(found[c] for c in (*_FIELDS, *_COUNTED))], ", ".join([*(f"{c} double" for c in _FIELDS), *(f"{c} long" for c in _COUNTED)]))
    return _rounded(one, *_FIELDS)


_query("offline_metrics", _metrics_sql("SELECT " + ", ".join([*(f"round({v}, 6) {k}" for k, v in _FIELDS.items()), *(f"{v} {k}" for k, v in _COUNTED.items())]), relevance=_GRADED, walk=True, more="".join(_slice_sql(w, r, n) for n, (w, r) in _SLICES.items())))(_offline)

# ---- profiles -------------------------------------------------------------------------------------------------

_RAW_NAMES = ("user_id", "date", "timestamp", "action_type", "widget_name", "search_query", "item_id")


def _footers(s: SparkSession, d: str) -> DataFrame:
    parts = [counted_from_footers(s, f"{d}/{t}.parquet").withColumn("table_name", F.lit(t)) for t in _COUNTED_TABLES]
    return combined(parts[0], *parts[1:])


_COUNTED_TABLES = ("events", "lineitem", "orders", "part")
_query("footer_rows", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in _COUNTED_TABLES))(_footers)
_query("null_profile", _sql(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) row_count, count(*) - count({c}) null_count, (count(*) - count({c})) / count(*) null_share FROM raw" for c in _RAW_NAMES), "raw"))(lambda s, d: diagnostics.null_profile(raw_events(s, d)))
_query("action_profile", _sql("""SELECT action_type, count(*) AS rows, count(DISTINCT user_id) unique_users, count(DISTINCT item_id) unique_items, count(*) - count(item_id) missing_items, count(*) - count(widget_name) missing_widgets,
    (count(*) - count(item_id)) / count(*) missing_item_share, (count(*) - count(widget_name)) / count(*) missing_widget_share, round(count(*) / sum(count(*)) OVER (), 9) row_share FROM raw GROUP BY 1""", "raw"))(lambda s, d: diagnostics.action_profile(raw_events(s, d)).withColumn("row_share", F.round("row_share", 9)))  # fmt: skip
_OVERVIEW = "VALUES ('user_id', 'bigint'), ('date', 'date'), ('timestamp', 'timestamp_ntz'), ('action_type', 'string'), ('widget_name', 'string'), ('search_query', 'string'), ('item_id', 'bigint')"
_query("schema_overview", f"SELECT * FROM ({_OVERVIEW}) t(column_name, dtype)")(lambda s, d: diagnostics.schema_overview(raw_events(s, d)))
_GAP = "count(*) events, count(g) diffs, count(*) FILTER (g < 0) negative, count(*) FILTER (g = 0) zero, count(*) FILTER (g > 1800) over_timeout, CAST(sum(CASE WHEN g IS NULL OR g > 1800 THEN 1 ELSE 0 END) AS BIGINT) sessions, " + ", ".join(f"round(quantile_cont(g, {q}), 6) p{round(100 * q)}" for q in diagnostics.QUANTILES)
_QS = tuple(f"p{round(100 * q)}" for q in diagnostics.QUANTILES)
_query("gap_summary", _sql(f"SELECT {_GAP} FROM (SELECT *, date_sub('second', lag(timestamp) OVER (PARTITION BY user_id ORDER BY timestamp), timestamp) g FROM clean)", "clean"))(lambda s, d: _rounded(diagnostics.gap_summary(_clean(s, d)), *_QS))
_query("gap_summary_by_day", _sql(f"SELECT event_date, {_GAP} FROM (SELECT *, date_sub('second', lag(timestamp) OVER (PARTITION BY event_date, user_id ORDER BY timestamp), timestamp) g FROM clean) GROUP BY 1", "clean"))(lambda s, d: _rounded(diagnostics.gap_summary(_clean(s, d), by=["event_date"]), *_QS))
_query("user_activity", _sql("SELECT count(*) users, " + ", ".join(f"round(quantile_cont(n, {q}), 6) p{round(100 * q)}" for q in (0.5, 0.9, 0.95, 0.99)) + ", max(n) most FROM (SELECT user_id, count(*) n FROM clean GROUP BY 1)", "clean"))(lambda s, d: _rounded(eda.activity_quantiles(_clean(s, d)), "p50", "p90", "p95", "p99"))
_query("p99_users", _sql("SELECT count(*) users, CAST(sum(n) AS BIGINT) events, round(sum(n) / (SELECT count(*) FROM clean), 9) AS share FROM (SELECT user_id, count(*) n FROM clean GROUP BY 1) WHERE n >= (SELECT quantile_cont(n, 0.99) FROM (SELECT user_id, count(*) n FROM clean GROUP BY 1))", "clean"))(lambda s, d: eda.heavy_users(_clean(s, d)).withColumn("share", F.round("share", 9)))
_query("top_users", _sql("SELECT user_id, count(*) AS rows FROM clean GROUP BY 1 ORDER BY rows DESC, user_id LIMIT 50", "clean"))(lambda s, d: eda.top_values(_clean(s, d), "user_id", 50))
_query("popularity_concentration", _sql("SELECT CAST(n AS BIGINT) top_n, CAST(sum(events_count) AS BIGINT) events_count, round(sum(events_count) / (SELECT sum(events_count) FROM pop), 9) AS share FROM (VALUES (10), (100), (1000)) t(n) JOIN (SELECT *, row_number() OVER (ORDER BY events_count DESC, item_id) place FROM pop) ON place <= n GROUP BY 1", "clean", ("pop",)))(
    lambda s, d: eda.popularity_concentration(item_popularity(_clean(s, d))).withColumn("share", F.round("share", 9))
)
_query("top_per_action", _sql("SELECT action_type, item_id, events, place FROM (SELECT *, row_number() OVER (PARTITION BY action_type ORDER BY events DESC, item_id) place FROM (SELECT action_type, item_id, count(*) events FROM clean GROUP BY 1, 2)) WHERE place <= 100", "clean"))(lambda s, d: eda.top_per_action(_clean(s, d)))
_query("top_categories", "SELECT 'size_' || p_size category_name, count(*) AS rows FROM part GROUP BY 1 ORDER BY rows DESC, category_name LIMIT 30")(lambda s, d: eda.top_values(products(s, d), "category_name"))
_query("top_brands", "SELECT p_brand brand, count(*) AS rows FROM part GROUP BY 1 ORDER BY rows DESC, brand LIMIT 30")(lambda s, d: eda.top_values(products(s, d), "brand"))
_query("top_types", "SELECT p_type AS type, count(*) AS rows FROM part GROUP BY 1 ORDER BY rows DESC, type LIMIT 30")(lambda s, d: eda.top_values(products(s, d), "type"))
_query("catalog_reconciliation", _sql("SELECT (SELECT count(DISTINCT item_id) FROM clean WHERE item_id IN (SELECT item_id FROM prod)) matched, (SELECT count(DISTINCT item_id) FROM clean WHERE item_id NOT IN (SELECT item_id FROM prod)) log_only, (SELECT count(*) FROM prod WHERE item_id NOT IN (SELECT item_id FROM clean)) catalogue_only", "clean", ("prod",)))(
    lambda s, d: eda.catalogue_reconciliation(_clean(s, d), products(s, d))
)
_query("date_action_summary", _sql("SELECT event_date, action_type, count(*) events, round(count(*) / sum(count(*)) OVER (PARTITION BY event_date), 9) day_share FROM clean GROUP BY 1, 2", "clean"))(lambda s, d: eda.date_action_summary(_clean(s, d)).withColumn("day_share", F.round("day_share", 9)))
_query("widget_profile", _sql("SELECT widget_name, action_type, count(*) events, count(DISTINCT user_id) users, round(count(*) / sum(count(*)) OVER (), 9) AS share FROM clean GROUP BY 1, 2", "clean"))(lambda s, d: eda.widget_profile(_clean(s, d)).withColumn("share", F.round("share", 9)))


def _searches(s: SparkSession, d: str) -> DataFrame:
    """Brands of parts stand in for search queries, some of them missing, empty or blank."""
    return s.read.parquet(f"{d}/part.parquet").select(F.when(F.col("p_size") % 7 == 0, F.lit("  ")).when(F.col("p_size") % 5 == 0, F.lit("")).when(F.col("p_size") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit(" "), F.upper("p_brand"))).alias("search_query"))


_SEARCH = "WITH q AS (SELECT CASE WHEN p_size % 7 = 0 THEN '  ' WHEN p_size % 5 = 0 THEN '' WHEN p_size % 3 = 0 THEN NULL ELSE ' ' || upper(p_brand) END s FROM part) "
_query("search_quality", _SEARCH + "SELECT count(*) AS rows, count(*) - count(s) nulls, count(*) FILTER (s = '') empty, count(*) FILTER (s <> '' AND trim(s) = '') blank, count(DISTINCT lower(trim(s))) AS distinct FROM q")(lambda s, d: eda.search_quality(_searches(s, d)))
_query("top_queries", _SEARCH + "SELECT lower(trim(s)) AS query, count(*) AS rows FROM q WHERE trim(s) <> '' GROUP BY 1 ORDER BY rows DESC, query LIMIT 50")(lambda s, d: eda.top_queries(_searches(s, d)))
_query("sampled_session_lengths", None)(lambda s, d: eda.sampled_session_lengths(_sessions(s, d), 300))
_query("sampled_session_lengths_md5", _sql("SELECT count(*) sessions, " + ", ".join(f"round(quantile_cont(n, {q}), 6) p{round(100 * q)}" for q in (0.5, 0.9, 0.99)) + " FROM (SELECT user_id, session_index, count(*) n FROM sessions WHERE CAST('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000 < 300 GROUP BY 1, 2)", "sessions"))(
    lambda s, d: _rounded(eda.sampled_session_lengths(_sessions(s, d), 300, hashed=lambda u: F.conv(F.substring(F.md5(u.cast("string").cast("binary")), 1, 8), 16, 10).cast("long")), "p50", "p90", "p99")
)
_query("item_search", _sql("SELECT item_id, name item_name FROM prod WHERE contains(lower(coalesce(name, '')), 'a')", "raw", ("prod",)))(lambda s, d: eda.search_items(products(s, d).select("item_id", F.col("name").alias("item_name")), "A"))
_query("union_missing_columns", _sql("SELECT item_id, similar_item_id, score, rank, source, pair_count FROM top UNION ALL SELECT item_id, similar_item_id, score, rank, 'again', NULL FROM top", "top"))(
    lambda s, d: combined(_top(s, d).select("item_id", "similar_item_id", "score", "rank", "source", "pair_count"), _top(s, d).select("item_id", "similar_item_id", "score", "rank", F.lit("again").alias("source")))
)
