"""The same queries as SQL, for the side-by-side check with an independent engine."""

from __future__ import annotations

import re

from tidecast import fixtures as fx
from tidecast.functions import text
from tidecast.functions.scoring import ASPECTS, POLARITIES
from tidecast.plans.stumps import STUMP_CUTS, STUMP_FEATURES, STUMP_SETTINGS


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(_quoted(v) for v in values) + "]"


def _case(expr: str, values: dict) -> str:
    arms = " ".join(
        f"WHEN {_quoted(k) if isinstance(k, str) else k} THEN {_quoted(v)}"
        for k, v in values.items()
    )
    return f"CASE {expr} {arms} END"


def _replaced(expr: str, pairs: list[tuple[str, str]]) -> str:
    for old, new in pairs:
        expr = f"replace({expr}, {_quoted(old)}, {_quoted(new)})"
    return expr


def _tokens(expr: str) -> str:
    split = f"regexp_split_to_array({expr}, '{text.WHITESPACE}')"
    return f"list_filter({split}, lambda t: t <> '')"


def _masked(expr: str) -> str:
    names = " ".join(
        f"WHEN t = {_quoted(k)} THEN {_quoted(v)}" for k, v in text.EMOJI_NAMES.items()
    )
    mask = (
        "CASE WHEN starts_with(t, '@') THEN '@USER' "
        "WHEN starts_with(lower(t), 'http') OR starts_with(lower(t), 'www') THEN 'HTTPURL' "
        f"{names} ELSE t END"
    )
    return f"array_to_string(list_transform({_tokens(expr)}, lambda t: {mask}), ' ')"


def _normalized(expr: str) -> str:
    plain = f"replace({_replaced(expr, text.TYPOGRAPHIC)}, chr(13), ' ')"
    spoken = _replaced(_masked(plain), text.CONTRACTIONS)
    return f"trim(regexp_replace({spoken}, '{text.WHITESPACE}', ' ', 'g'))"


def _visible(expr: str) -> str:
    broken = f"regexp_replace({expr}, '(?i)<br\\s*/?>', chr(10), 'g')"
    bare = f"regexp_replace({broken}, '<[^>]*>', '', 'g')"
    return f"trim({_replaced(bare, text.HTML_ENTITIES)})"


K = "CAST(regexp_extract(props, '[0-9]+') AS INT)"
LEXICON = ", ".join(f"({_quoted(t)}, {_quoted(a)}, {w})" for t, a, w in fx.LEXICON)

# Views, each using only tables and the views above it.
VIEWS = {
    "fx_posts": f"""
        SELECT event_id, ts, CAST(ts AS DATE) AS date, 's' || user_id AS series_id,
               user_id AS author, value,
               {_case("event_id % 4", dict(enumerate(fx.SOURCES)))} AS media,
               {_case("event_type", {"click": "ECONOMY", "view": "TECHNOLOGY",
                                     "purchase": "GENERAL", "signup": "COMMUNITY",
                                     "error": "SECURITY"})} AS aspect,
               {_case(f"{K} % 3", {0: "POSITIVE", 1: "NEGATIVE", 2: "NONE"})} AS polarity
        FROM events""",
    "fx_totals": """
        SELECT series_id, date,
               count(*) FILTER (polarity = 'POSITIVE') AS total_positive,
               count(*) FILTER (polarity = 'NEGATIVE') AS total_negative,
               count(*) FILTER (polarity = 'NONE') AS total_none
        FROM fx_posts GROUP BY ALL""",
    "fx_articles": f"""
        SELECT doc_id, DATE '2024-01-01' + CAST(doc_id % 30 AS INT) AS date,
               CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INT) AS TIMESTAMP)
                   + to_seconds(doc_id % 86400) AS ts,
               lang, source,
               {_case("doc_id % 3", {0: "twitter", 1: "cnn", 2: "bitcoin_news"})} AS media,
               CASE WHEN doc_id % 3 <> 0 THEN split_part(text, chr(10), 1) END AS title,
               text AS article
        FROM documents""",
    "fx_close": """
        SELECT series_id, date, max_by(value, row(ts, event_id)) AS close_price
        FROM fx_posts GROUP BY ALL""",
    "fx_prices": """
        SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS date,
               max_by(o_totalprice, o_orderkey) AS close_price
        FROM orders GROUP BY ALL""",
    "fx_views": """
        SELECT 's' || user_id AS series_id, CAST(ts AS DATE) AS date, count(*) AS views
        FROM events WHERE event_type = 'view' GROUP BY ALL""",
    "fx_trends": """
        SELECT series_id, date,
               CASE WHEN series_id = 's0' AND date = (SELECT max(date) FROM fx_views)
                    THEN 0 ELSE views END AS trends
        FROM fx_views""",
    "fx_metrics": f"""
        SELECT series_id, date, {_case("event_id % 6", dict(enumerate(fx.METRICS)))} AS metric,
               round(sum(value), 4) AS v
        FROM fx_posts GROUP BY ALL""",
    "fx_influencers": """
        SELECT c_custkey AS handle, c_acctbal AS rank, c_nationkey AS token FROM customer""",
    "fx_listed": "SELECT * FROM fx_influencers ORDER BY rank DESC, handle LIMIT 300",
    "fx_order_posts": """
        SELECT o_orderkey AS tweet_id, CAST(o_orderdate AS DATE) AS date, o_custkey AS author,
               o_orderpriority AS series_id
        FROM orders""",
    "fx_api_users": """
        SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS id, c_name AS username
        FROM customer JOIN orders ON o_custkey = c_custkey""",
    "fx_api_places": """
        SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS id, 'N' || n_nationkey AS country_code,
               n_name AS country, n_name || ', ' || r_name AS full_name
        FROM nation JOIN region ON n_regionkey = r_regionkey
        JOIN orders ON o_orderkey % 3 = 0 AND o_orderkey % 25 = n_nationkey""",
    "fx_raw_posts": """
        SELECT event_id, ts, CAST(ts AS DATE) AS date,
               '@u' || user_id || ' I can''t  see http://x.co/' || event_id || ' cannot '
               || event_type || ' #' || event_type || ' 🚀 at 5 p . m . it’s… '
               || CASE WHEN event_id % 2 = 0 THEN 'we''re @josé_x WWW.A.B'
                       ELSE 'they''ll ' || chr(13) || ' go' END AS article
        FROM events""",
    "fx_relative": f"""
        SELECT event_id, event_type, ts AS scraped_at,
               CASE WHEN event_id % 11 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                    WHEN event_id % 13 = 0 THEN 'just now'
                    WHEN event_id % 17 = 0
                        THEN '1 day ' || regexp_extract(props, '[0-9]+') || ' hours ago'
                    ELSE regexp_extract(props, '[0-9]+') || ' ' || list_extract(
                        ['second', 'min', 'minute', 'hour', 'day', 'week', 'month', 'year'],
                        CAST(event_id % 8 AS INT) + 1) || 's ago' END AS said
        FROM events""",
    "fx_probs": """
        SELECT d.doc_id, lang, DATE '2024-01-01' + CAST(d.doc_id % 30 AS INT) AS date,
               (n_chars % 100) / 100.0 AS p, quality = 1 AS actual
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "fx_returns": """
        SELECT *, ln((close_price + 0.5) / (lag(close_price) OVER w + 0.5)) AS price_diff
        FROM fx_prices WINDOW w AS (PARTITION BY series_id ORDER BY date)""",
    "fx_predictions": """
        SELECT series_id, date, close_price,
               CASE WHEN price_diff > 0 THEN 'Up' ELSE 'Down' END AS prediction
        FROM fx_returns WHERE price_diff IS NOT NULL""",
    "fx_relevant": f"""
        SELECT * FROM (
            SELECT doc_id, media, date, {_normalized("content")} AS content
            FROM (SELECT doc_id, media, date,
                         CASE WHEN media = 'twitter' THEN article ELSE title || ' ' || article END
                             AS content
                  FROM fx_articles))
        WHERE contains(lower(content), 'the')""",
    "fx_words": f"""
        SELECT doc_id, {_tokens("lower(article)")} AS tokens FROM fx_articles""",
    "fx_vocab": """
        SELECT token, n, row_number() OVER (ORDER BY n DESC, token) + 2 AS token_id
        FROM (SELECT token, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM fx_words)
              GROUP BY token ORDER BY n DESC, token LIMIT 2000)""",
    "fx_asof": """
        SELECT p.series_id, p.date, p.close_price, r.close_price AS last_price,
               r.prediction AS last_prediction
        FROM fx_prices p ASOF LEFT JOIN fx_predictions r
          ON p.series_id = r.series_id AND p.date > r.date""",
    "fx_outcomes": """
        SELECT series_id, strftime(date, '%Y-%m-%d') || ' 07:00:00' AS datetime,
               close_price AS price, CAST(day(date) AS INT) AS day,
               round(close_price - last_price, 4) + 0.0 AS price_diff,
               CASE WHEN last_prediction IS NULL THEN ''
                    WHEN (close_price > last_price AND last_prediction = 'Up')
                      OR (close_price < last_price AND last_prediction = 'Down') THEN 'Correct'
                    ELSE 'Wrong' END AS outcome
        FROM fx_asof""",
}

PERIOD = "BETWEEN DATE '2024-01-02' AND DATE '2024-01-30'"
_SENTIMENT = ",\n".join(
    f"""count(*) FILTER (media = '{s}') AS docs_{s},
        count(*) FILTER (media = '{s}' AND polarity = 'POSITIVE') AS pos_{s},
        count(*) FILTER (media = '{s}' AND polarity = 'NEGATIVE') AS neg_{s}"""
    for s in fx.SOURCES
)
_SCORES = ",\n".join(
    f"""CASE WHEN docs_{s} > 0 THEN (pos_{s} - neg_{s}) / CAST(docs_{s} AS DOUBLE) ELSE 0.0 END
            AS {s}_score,
        CASE WHEN docs_{s} > 0 THEN ln((pos_{s} + 0.5) / (neg_{s} + 0.5)) ELSE 0.0 END
            AS {s}_pos_neg_ratio"""
    for s in fx.SOURCES
)
_METRIC_COLUMNS = ",\n".join(f"max(v) FILTER (metric = '{m}') AS {m}" for m in fx.METRICS)
_METRIC_ZERO = ",\n".join(f"coalesce({m}, 0.0) AS {m}" for m in fx.METRICS)

VIEWS["fx_features"] = f"""
    SELECT s.series_id, s.date,
           {_SCORES},
           coalesce(t.trends, 0) AS trends,
           {_METRIC_ZERO},
           coalesce(i.influence_score, 0.0) AS influence_score,
           coalesce(p.docs_twitter_influencers, 0) AS influencer_appearances,
           coalesce(c.price_diff, 0.0) AS price_diff,
           coalesce(c.close_price, 0.0) AS close_price,
           c.is_price_up,
           coalesce(p.pos_twitter, 0) AS total_positive,
           coalesce(p.neg_twitter, 0) AS total_negative
    FROM (SELECT series_id, CAST(d AS DATE) AS date
          FROM (SELECT DISTINCT series_id FROM fx_close),
               generate_series(DATE '2024-01-03', DATE '2024-01-30', INTERVAL 1 DAY) AS g(d)) s
    LEFT JOIN (SELECT series_id, date, {_SENTIMENT}
               FROM fx_posts WHERE date {PERIOD} GROUP BY ALL) p USING (series_id, date)
    LEFT JOIN (SELECT series_id, date + 2 AS date, trends
               FROM fx_trends WHERE date {PERIOD}) t USING (series_id, date)
    LEFT JOIN (SELECT series_id, date, {_METRIC_COLUMNS}
               FROM fx_metrics WHERE date {PERIOD} GROUP BY ALL) m USING (series_id, date)
    LEFT JOIN (SELECT series_id, date, sum(rank) AS influence_score
               FROM fx_posts JOIN fx_influencers ON author = handle
               WHERE media = 'twitter_influencers' AND date {PERIOD} GROUP BY ALL) i
           USING (series_id, date)
    LEFT JOIN (SELECT series_id, date, close_price,
                      ln((close_price + 0.5) / (lag(close_price) OVER w + 0.5)) AS price_diff,
                      lead(close_price) OVER w > close_price AS is_price_up
               FROM fx_close WHERE date {PERIOD}
               WINDOW w AS (PARTITION BY series_id ORDER BY date)) c USING (series_id, date)"""
VIEWS["fx_forecasts"] = """
    SELECT series_id, date, close_price, is_price_up, 1.0 / (1.0 + exp(-price_diff)) AS p,
           CASE WHEN 1.0 / (1.0 + exp(-price_diff)) > 0.5 THEN 'Up' ELSE 'Down' END AS prediction,
           total_positive AS positive, total_negative AS negative, trends,
           bitcoin_news_score AS news_sentiment
    FROM fx_features"""
VIEWS["fx_latest"] = """
    SELECT * FROM fx_forecasts QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY date DESC) = 1"""


VIEWS["fx_stump_rows"] = f"""
    SELECT t.trial, t.eta, t.min_gain, t.l1, t.l2, f.fold_id, series_id, date, is_price_up,
           [{", ".join(f"{c}::DOUBLE" for c in STUMP_FEATURES)}] AS x,
           date >= start - 14 AND date < start AND is_price_up IS NOT NULL AS learns,
           date >= start AND date < start + 7 AS tests
    FROM fx_features, (VALUES {", ".join(f"({k}, {', '.join(f'{v}::DOUBLE' for v in own)})" for k, own in enumerate(STUMP_SETTINGS))})
             AS t(trial, eta, min_gain, l1, l2),
         (SELECT k AS fold_id, min(date) + 14 + 7 * k::INT AS start FROM fx_features, range(100) AS r(k)
          GROUP BY k HAVING min(date) + 14 + 7 * k::INT <= max(date)) AS f
    WHERE date >= start - 14 AND date < start + 7"""


def _stump_rounds(rounds: int) -> str:
    """Rounds of boosting with one split each, as common table expressions ``margins1``, ``margins2``, ...

    A round sums gradients and hessians per bound, takes the bound of the largest gain (ties: the first
    feature, the lowest bound) and moves each row's margin by the weight of its side.
    """
    whole = ["margins0 AS (SELECT *, 0.0::DOUBLE AS margin FROM fx_stump_rows)"]
    score = "greatest(abs({g}) - l1, 0.0) * greatest(abs({g}) - l1, 0.0) / ({h} + l2)"
    weight = "-eta * (sign({g}) * greatest(abs({g}) - l1, 0.0)) / ({h} + l2)"
    for k in range(1, rounds + 1):
        whole.append(f"""sloped{k} AS (
            SELECT trial, fold_id, eta, min_gain, l1, l2, x,
                round((p - is_price_up::INT) * 16777216) / 16777216 AS g, round(p * (1 - p) * 16777216) / 16777216 AS h
            FROM (SELECT *, 1 / (1 + exp(-margin)) AS p FROM margins{k - 1} WHERE learns)
        ), totals{k} AS (
            SELECT trial, fold_id, any_value(eta) AS eta, any_value(min_gain) AS min_gain, any_value(l1) AS l1,
                any_value(l2) AS l2, sum(g) AS g, sum(h) AS h
            FROM sloped{k} GROUP BY trial, fold_id
        ), sides{k} AS (
            SELECT trial, fold_id, i, cut, sum(g) AS gl, sum(h) AS hl
            FROM sloped{k}, range(1, {len(STUMP_FEATURES) + 1}) AS f(i), (SELECT unnest({STUMP_CUTS}) AS cut)
            WHERE x[i] <= cut GROUP BY trial, fold_id, i, cut
        ), chosen{k} AS (
            SELECT trial, fold_id, i, cut, gl, hl
            FROM (SELECT *, {score.format(g="gl", h="hl")} + {score.format(g="(g - gl)", h="(h - hl)")}
                      - {score.format(g="g", h="h")} AS gain
                  FROM sides{k} JOIN totals{k} USING (trial, fold_id))
            WHERE gain > min_gain AND hl >= 1 AND h - hl >= 1
            QUALIFY row_number() OVER (PARTITION BY trial, fold_id ORDER BY gain DESC, i, cut) = 1
        ), margins{k} AS (
            SELECT m.* EXCLUDE margin, margin + coalesce(CASE
                WHEN i IS NULL THEN {weight.format(g="g", h="h").replace("eta", "m.eta").replace("l1", "m.l1").replace("l2", "m.l2")}
                WHEN x[i] <= cut THEN {weight.format(g="gl", h="hl").replace("eta", "m.eta").replace("l1", "m.l1").replace("l2", "m.l2")}
                ELSE {weight.format(g="(g - gl)", h="(h - hl)").replace("eta", "m.eta").replace("l1", "m.l1").replace("l2", "m.l2")}
                END, 0.0) AS margin
            FROM margins{k - 1} AS m LEFT JOIN totals{k} USING (trial, fold_id) LEFT JOIN chosen{k} USING (trial, fold_id)
        )""")
    return ", " + ", ".join(whole)


_STUMPED = _stump_rounds(2)


def with_views(body: str) -> str:
    """The statement with the views it uses, directly or through others, put before it."""
    needed: set[str] = set()
    found = [body]
    while found:
        for name in set(re.findall(r"\bfx_\w+", found.pop())) - needed:
            needed.add(name)
            found.append(VIEWS[name])
    listed = ",\n".join(f"{n} AS ({sql})" for n, sql in VIEWS.items() if n in needed)
    return f"WITH {listed}\n{body}" if listed else body


_DOUBLES = [
    *[f"{s}_{x}" for s in fx.SOURCES for x in ("score", "pos_neg_ratio")],
    *fx.METRICS,
    "influence_score",
    "price_diff",
    "close_price",
]
_ROUNDED = ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in _DOUBLES)
_SPINE = """(SELECT series_id, CAST(d AS DATE) AS date
    FROM (SELECT DISTINCT series_id FROM fx_prices),
         generate_series(DATE '{start}', DATE '2001-08-01', INTERVAL 1 DAY) AS g(d))"""
_LONG_START = "1996-02-08"
_AFTER_LONG_START = "1996-02-09"
_FOLDS = """(SELECT k AS fold_id, s AS start_train, s + 365 AS end_train, s + 367 AS start_test,
           s + 397 AS end_test
    FROM (SELECT k, (SELECT min(date) FROM fx_prices) + CAST(30 * k AS INT) AS s
          FROM range(1000) AS r(k))
    WHERE s + 367 <= (SELECT max(date) FROM fx_prices))"""
_DIGITS = [
    ("second", "to_seconds"),
    ("min", "to_minutes"),
    ("minute", "to_minutes"),
    ("hour", "to_hours"),
    ("day", "to_days"),
    ("week", "to_weeks"),
    ("month", "to_months"),
    ("year", "to_years"),
]
_RELATIVE = " ".join(
    f"WHEN regexp_matches(said, '[0-9]+ {u}s? ago') THEN scraped_at - "
    f"{f}(CAST(regexp_extract(said, '([0-9]+) {u}s? ago', 1) AS INT))"
    for u, f in _DIGITS
)
_SEARCH = """
    FROM fx_articles
    WHERE lang = 'en' AND contains(lower(article), 'the')
      AND ts BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-26 23:59:59'
      AND NOT regexp_matches(lower(article),
          '(^|[^\\p{L}\\p{N}_])(whst|heention)([^\\p{L}\\p{N}_]|$)')"""
_LINES = "string_split(article, chr(10))"
_BODY = "regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', '', 'g')"
_PIECES = f"list_slice(regexp_split_to_array({_BODY}, '<p(?:\\s[^>]*)?>'), 2, 1000000)"
_PARAGRAPHS = (
    f"list_transform({_PIECES}, lambda p: {_visible(chr(115) + 'plit_part(p, ' + _quoted('</p>') + ', 1)')})"
)
_DAILY_ARTICLES = """
    SELECT date, media, count(*) AS n, CAST(sum(length(article)) AS BIGINT) AS n_chars
    FROM {rows} GROUP BY ALL"""
_DISTINCT_ARTICLES = "(SELECT DISTINCT title, article, date, media FROM fx_articles)"
_ACCURACY = """(SELECT {keys}, avg(acc) AS mean_acc, stddev_pop(acc) AS std_acc
    FROM (SELECT {keys}, run, avg(hit) AS acc
          FROM (SELECT {keys}, CAST((p > 0.5) = actual AS INT) AS hit,
                       (row_number() OVER (PARTITION BY {keys} ORDER BY {order}) - 1) // 7 AS run
                FROM {rows})
          GROUP BY ALL) GROUP BY ALL)"""
_JUDGED = """(SELECT series_id, date, p, is_price_up AS actual FROM (
        SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) AS back
        FROM fx_forecasts) WHERE is_price_up IS NOT NULL AND back {side} 14)"""
_TRAIN = _ACCURACY.format(keys="series_id", order="date", rows=_JUDGED.format(side=">"))
_TEST = _ACCURACY.format(keys="series_id", order="date", rows=_JUDGED.format(side="<="))
_EVENTS = "SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS date FROM events"
_LEXICON_SUMS = ", ".join(
    f"coalesce(sum(weight) FILTER (aspect = '{a}'), 0) AS {a}" for a in ASPECTS
)

BODIES = {
    "feature_table": f"""
        SELECT series_id, date, {_ROUNDED}, trends, influencer_appearances, is_price_up
        FROM fx_features""",
    "calendar_fill": f"""
        SELECT series_id, date, coalesce(close_price, 0.0) AS close_price
        FROM {_SPINE.format(start=_AFTER_LONG_START)} LEFT JOIN fx_prices USING (series_id, date)""",
    "calendar_spine": f"SELECT * FROM {_SPINE.format(start=_LONG_START)}",
    "date_shift": "SELECT series_id, date + 2 AS date, trends FROM fx_trends",
    "latest_row": """
        SELECT series_id, date, close_price, round(price_diff, 6) + 0.0 AS price_diff
        FROM fx_returns
        QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY date DESC) = 1""",
    "union_sources": """
        SELECT series_id, date, total_positive, total_negative, total_none, 0 AS trends
        FROM fx_totals
        UNION ALL SELECT series_id, date, 0, 0, 0, trends FROM fx_trends""",
    "daily_close": """
        SELECT event_type AS series_id, CAST(ts AS DATE) AS date,
               max_by(value, row(epoch_ms(ts), event_id)) AS close_price
        FROM events GROUP BY ALL""",
    "log_return": """
        SELECT series_id, date, close_price, round(price_diff, 6) + 0.0 AS price_diff
        FROM fx_returns""",
    "up_label": """
        SELECT *, lead(close_price) OVER (PARTITION BY series_id ORDER BY date) > close_price
            AS is_price_up FROM fx_prices""",
    "metric_range_filter": """
        SELECT * FROM fx_metrics WHERE date >= DATE '2024-01-05' AND date < DATE '2024-01-21'""",
    "metric_pivot": "SELECT CAST(ts AS DATE) AS date, "
    + ", ".join(
        f"round(sum(value) FILTER (event_type = '{m}'), 4) AS {m}" for m in fx.EVENT_METRICS
    )
    + " FROM events GROUP BY ALL",
    "drop_trailing_zero": """
        SELECT * FROM fx_trends
        QUALIFY NOT (trends = 0
            AND row_number() OVER (PARTITION BY series_id ORDER BY date DESC) = 1)""",
    "aspect_polarity_count": """
        SELECT series_id, date, aspect, polarity, count(*) AS n FROM fx_posts GROUP BY ALL""",
    "polarity_totals": "SELECT * FROM fx_totals",
    "polarity_score": """
        SELECT series_id, date, round((total_positive - total_negative)
            / CAST(nullif(total_positive + total_negative + total_none, 0) AS DOUBLE), 6) + 0.0
            AS score FROM fx_totals""",
    "pos_neg_ratio": """
        SELECT series_id, date,
               round(ln((total_positive + 0.5) / (total_negative + 0.5)), 6) + 0.0 AS ratio
        FROM fx_totals""",
    "docs_per_day": "SELECT media, date, count(*) AS total_docs FROM fx_articles GROUP BY ALL",
    "sentiment_record": """
        SELECT media, date, aspect, polarity, count(*) AS n,
               CAST(sum(count(*)) OVER (PARTITION BY media, date) AS BIGINT) AS total_docs
        FROM fx_posts GROUP BY media, date, aspect, polarity""",
    "scan_window_json": """
        SELECT media, date, count(*) FILTER (polarity = 'POSITIVE') AS total_positive,
               count(*) FILTER (polarity = 'NEGATIVE') AS total_negative,
               count(*) FILTER (polarity = 'NONE') AS total_none
        FROM fx_posts WHERE date BETWEEN DATE '2024-01-12' AND DATE '2024-01-20' GROUP BY ALL""",
    "build_content": """
        SELECT doc_id, CASE WHEN media = 'twitter' THEN article ELSE title || ' ' || article END
            AS content FROM fx_articles""",
    "sample_n_per_day": """
        SELECT event_id, media, date FROM fx_posts
        QUALIFY row_number() OVER (PARTITION BY media, date
            ORDER BY md5('42-' || event_id), event_id) <= 20""",
    "aspect_expand": f"""
        SELECT doc_id, aspect, 'btc - bitcoin - ' || lower(aspect) AS pseudo_sentence
        FROM (SELECT doc_id, unnest({_list(ASPECTS)}) AS aspect FROM fx_articles)""",
    "argmax_label": f"""
        SELECT event_id, list_extract({_list(POLARITIES)}, list_position(p, list_max(p)))
            AS polarity
        FROM (SELECT event_id, [({K} % 7) / 7.0, ({K} % 5) / 5.0, ({K} % 3) / 3.0] AS p
              FROM events)""",
    "lexicon_polarity": f"""
        SELECT doc_id, aspect, CAST(score AS BIGINT) AS score,
               CASE WHEN score > 0 THEN 'POSITIVE' WHEN score < 0 THEN 'NEGATIVE' ELSE 'NONE' END
                   AS polarity
        FROM (SELECT doc_id, {_LEXICON_SUMS}
              FROM fx_words
              LEFT JOIN (SELECT doc_id, aspect, weight
                         FROM (SELECT doc_id, unnest(tokens) AS token FROM fx_words)
                         JOIN (VALUES {LEXICON}) lexicon(token, aspect, weight) USING (token)) hits
                  USING (doc_id)
              GROUP BY doc_id)
        UNPIVOT (score FOR aspect IN ({", ".join(ASPECTS)}))""",
    "sentiment_extraction": f"""
        SELECT media, date, aspect, polarity, count(*) AS n, any_value(total_docs) AS total_docs
        FROM (SELECT media, date, aspect,
                     CASE WHEN score > 0 THEN 'POSITIVE' WHEN score < 0 THEN 'NEGATIVE'
                          ELSE 'NONE' END AS polarity
              FROM (SELECT doc_id, media, date, {_LEXICON_SUMS}
                    FROM fx_relevant
                    LEFT JOIN (SELECT doc_id, aspect, weight
                               FROM (SELECT doc_id, unnest({_tokens("lower(content)")}) AS token
                                     FROM fx_relevant)
                               JOIN (VALUES {LEXICON}) lexicon(token, aspect, weight)
                                   USING (token)) hits USING (doc_id)
                    GROUP BY ALL)
              UNPIVOT (score FOR aspect IN ({", ".join(ASPECTS)})))
        JOIN (SELECT media, date, count(*) AS total_docs FROM fx_articles GROUP BY ALL) totals
            USING (media, date)
        GROUP BY media, date, aspect, polarity""",
    "top_influencers": """
        SELECT * FROM fx_influencers
        QUALIFY row_number() OVER (PARTITION BY token ORDER BY rank DESC, handle) <= 20""",
    "influence_join": """
        SELECT tweet_id, date, handle, rank FROM fx_order_posts JOIN fx_influencers
        ON author = handle""",
    "posts_by_influencers": """
        SELECT * FROM fx_order_posts WHERE author IN (SELECT handle FROM fx_listed)""",
    "influence_score": """
        SELECT series_id, date, round(coalesce(sum(rank), 0.0), 4) + 0.0 AS influence_score
        FROM fx_order_posts LEFT JOIN fx_influencers ON author = handle GROUP BY ALL""",
    "flatten_pages": """
        SELECT 'post' AS kind, CAST(o_orderkey AS VARCHAR) AS id, 'order ' || o_orderkey AS article
        FROM orders
        UNION ALL SELECT 'user', id, username FROM fx_api_users
        UNION ALL SELECT 'place', id, full_name FROM fx_api_places""",
    "post_type": """
        SELECT CAST(o_orderkey AS VARCHAR) AS tweet_id,
               CASE WHEN o_orderkey % 5 = 0 THEN 'type' || length(o_orderpriority) END AS tweet_type,
               CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 25 AS VARCHAR) END AS geo_id
        FROM orders""",
    "expand_metrics": """
        SELECT CAST(o_orderkey AS VARCHAR) AS tweet_id, count(l_orderkey) AS retweet_count,
               CAST(0 AS BIGINT) AS reply_count,
               CAST(coalesce(sum(l_quantity), 0) AS BIGINT) AS like_count,
               CAST(0 AS BIGINT) AS quote_count
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
    "enrich_author": """
        SELECT CAST(o_orderkey AS VARCHAR) AS tweet_id, CAST(o_custkey AS VARCHAR) AS author_id,
               username AS username_source
        FROM orders LEFT JOIN fx_api_users ON id = CAST(o_custkey AS VARCHAR)""",
    "enrich_reply_target": """
        SELECT CAST(o_orderkey AS VARCHAR) AS tweet_id, target AS in_reply_to_user_id,
               username AS username_target
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0
                  THEN CAST((o_orderkey * 7) % 1500 AS VARCHAR) END AS target FROM orders)
        LEFT JOIN fx_api_users ON id = target""",
    "enrich_place": """
        SELECT CAST(o_orderkey AS VARCHAR) AS tweet_id, geo AS geo_id, country_code, country,
               full_name
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0
                  THEN CAST(o_orderkey % 25 AS VARCHAR) END AS geo FROM orders)
        LEFT JOIN fx_api_places ON id = geo""",
    "enrich_posts": """
        SELECT CAST(o_orderkey AS VARCHAR) AS tweet_id, a.username AS username_source, r.username AS username_target,
               country_code, country, full_name, 'twitter' AS media, CAST(NULL AS VARCHAR) AS headline
        FROM orders
        LEFT JOIN fx_api_users AS a ON a.id = CAST(o_custkey AS VARCHAR)
        LEFT JOIN fx_api_users AS r ON o_orderkey % 2 = 0 AND r.id = CAST((o_orderkey * 7) % 1500 AS VARCHAR)
        LEFT JOIN fx_api_places AS p ON o_orderkey % 3 = 0 AND p.id = CAST(o_orderkey % 25 AS VARCHAR)""",
    "keyword_search": f"SELECT doc_id, ts, media {_SEARCH}",
    "capped_scan": f"SELECT doc_id, ts {_SEARCH} ORDER BY ts, doc_id LIMIT 100",
    "dedup_rows": f"""
        SELECT date, media, title, sha256(article) AS article FROM {_DISTINCT_ARTICLES}""",
    "dedup_first": """
        SELECT user_id, event_id, ts, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
    "normalize_text": f"""
        SELECT event_id, {_normalized("article")} AS article FROM fx_raw_posts""",
    "mask_tokens": f"SELECT event_id, {_masked('article')} AS article FROM fx_raw_posts",
    "extract_mentions": f"""
        SELECT event_id, nullif(array_to_string(regexp_extract_all(article, '@{text.WORD}'), ' '),
            '') AS mentions FROM fx_raw_posts""",
    "extract_hashtags": f"""
        SELECT event_id, nullif(array_to_string(regexp_extract_all(article, '#{text.WORD}'), ' '),
            '') AS hashtags FROM fx_raw_posts""",
    "cut_at_marker": """
        SELECT doc_id, split_part(article || chr(10) || 'Image Credits: ' || source,
            'Image Credits', 1) AS article FROM fx_articles""",
    "trim_boilerplate": f"""
        SELECT doc_id, CASE WHEN len({_LINES}) > 3 THEN
            array_to_string(list_slice({_LINES}, 2, len({_LINES}) - 2), chr(10)) ELSE '' END
            AS article FROM fx_articles""",
    "parse_three_line": """
        SELECT doc_id, CASE WHEN len(l) = 3 THEN l[1] END AS title,
               CASE WHEN len(l) = 3 THEN l[2] END AS date_text,
               CASE WHEN len(l) = 3 THEN l[3] END AS article
        FROM (SELECT doc_id, string_split(article, chr(10)) AS l FROM fx_articles)""",
    "page_article": f"""
        SELECT page_id,
               {_visible("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)")} AS headline,
               split_part(array_to_string({_PARAGRAPHS}, chr(10)), 'Image Credits', 1) AS article
        FROM pages""",
    "relative_time": f"""
        SELECT event_id, CASE {_RELATIVE} ELSE try_cast(said AS TIMESTAMP) END AS resolved
        FROM fx_relative""",
    "parse_year_month": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year,
               CAST(month(o_orderdate) AS INT) AS month FROM orders""",
    "parse_decimal_comma": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 97 <> 0 THEN round(o_totalprice, 2) END AS price
        FROM orders""",
    "build_vocab": "SELECT token, n, token_id FROM fx_vocab",
    "encode_fixed_length": """
        SELECT doc_id, n_tokens,
               array_to_string(list_concat(ids, list_transform(range(128 - n_tokens),
                   lambda x: 0)), ' ') AS input_ids
        FROM (SELECT doc_id, count(*) AS n_tokens,
                     list(coalesce(token_id, 1) ORDER BY place) AS ids
              FROM (SELECT doc_id, unnest(list_slice(tokens, 1, 128)) AS token,
                           generate_subscripts(list_slice(tokens, 1, 128), 1) AS place
                    FROM fx_words) LEFT JOIN fx_vocab USING (token)
              GROUP BY doc_id)""",
    "fold_table": f"SELECT * FROM {_FOLDS} f",
    "rolling_folds": f"""
        SELECT series_id, date, fold_id,
               CASE WHEN date < end_train THEN 'train' ELSE 'test' END AS role
        FROM fx_prices JOIN {_FOLDS} f
          ON (date >= start_train AND date < end_train) OR (date >= start_test AND date < end_test)""",
    "monthly_folds": """
        SELECT series_id, date, fold_id, CASE WHEN date < end_train THEN 'train' ELSE 'test' END AS role
        FROM fx_prices JOIN (
            SELECT k AS fold_id, CAST(DATE '1996-01-01' + to_months(CAST(3 * k AS INT)) AS DATE) AS start_train,
                   CAST(DATE '1997-01-01' + to_months(CAST(3 * k AS INT)) AS DATE) AS end_train,
                   CAST(DATE '1997-02-01' + to_months(CAST(3 * k AS INT)) AS DATE) AS start_test,
                   CAST(DATE '1997-05-01' + to_months(CAST(3 * k AS INT)) AS DATE) AS end_test
            FROM range(100) AS r(k)) f
          ON (date >= start_train AND date < end_train) OR (date >= start_test AND date < end_test)
        WHERE start_test <= (SELECT max(date) FROM fx_prices)""",
    "holdout_split": """
        SELECT series_id, date, close_price, CASE WHEN row_number() OVER (PARTITION BY series_id
            ORDER BY date DESC) <= 14 THEN 'test' ELSE 'train' END AS role FROM fx_prices""",
    "split_dates": """
        SELECT series_id, max(date) FILTER (up = 201) AS tuning_start,
               max(date) FILTER (down = 14) AS holdout_start
        FROM (SELECT series_id, date,
                     row_number() OVER (PARTITION BY series_id ORDER BY date) AS up,
                     row_number() OVER (PARTITION BY series_id ORDER BY date DESC) AS down
              FROM fx_prices) GROUP BY series_id""",
    "threshold_class": """
        SELECT doc_id, CASE WHEN p > 0.5 THEN 'Up' ELSE 'Down' END AS prediction FROM fx_probs""",
    "macro_f1": """
        SELECT lang, round(avg(2.0 * hits / (2 * hits + missed)), 6) + 0.0 AS macro_f1
        FROM (SELECT lang, c, count(*) FILTER (actual = c AND (p > 0.5) = c) AS hits,
                     count(*) FILTER ((actual = c) <> ((p > 0.5) = c)) AS missed
              FROM fx_probs, (VALUES (true), (false)) classes(c) GROUP BY ALL)
        WHERE hits + missed > 0 GROUP BY lang""",
    "windowed_accuracy": "SELECT lang, round(mean_acc, 6) + 0.0 AS mean_acc, "
    "round(std_acc, 6) + 0.0 AS std_acc FROM "
    + _ACCURACY.format(keys="lang", order="date, doc_id", rows="fx_probs"),
    "score_predictions": """
        SELECT series_id, date, close_price, prediction, round(change, 4) + 0.0 AS price_diff,
               CASE WHEN change IS NULL THEN ''
                    WHEN (change > 0 AND prediction = 'Up') OR (change < 0 AND prediction = 'Down')
                    THEN 'Correct' ELSE 'Wrong' END AS outcome
        FROM (SELECT *, lead(close_price) OVER (PARTITION BY series_id ORDER BY date) - close_price
                  AS change FROM fx_predictions)""",
    "asof_last_prediction": "SELECT * FROM fx_asof",
    "asof_events": """
        SELECT c.event_id, c.user_id, c.ts,
               CASE WHEN c.ts - v.ts <= INTERVAL 2 DAY THEN v.event_id END AS view_id,
               CASE WHEN c.ts - v.ts <= INTERVAL 2 DAY THEN v.value END AS view_value,
               CASE WHEN c.ts - v.ts <= INTERVAL 2 DAY THEN v.ts END AS view_ts
        FROM (SELECT * FROM events WHERE event_type = 'click') AS c
        ASOF LEFT JOIN (
            SELECT * FROM events WHERE event_type = 'view'
            QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1
        ) AS v ON c.user_id = v.user_id AND c.ts > v.ts""",
    "ledger_append": """
        SELECT series_id, datetime, price, day, price_diff,
               CASE WHEN datetime < '2000-01-01' THEN 'Stored' ELSE outcome END AS outcome
        FROM fx_outcomes""",
    "current_prediction": """
        SELECT series_id, strftime(date + 1, '%d/%m/%Y') AS target_date,
               CASE WHEN series_id = 's2' THEN -1.0 ELSE close_price END AS reference_price,
               prediction, positive, negative, trends
        FROM fx_latest""",
    "prediction_history": """
        SELECT series_id, strftime(date + 1, '%Y-%m-%d') || ' 07:00:00' AS predicted_for,
               round(p + 1e-9, 6) + 0.0 AS p, prediction, positive, negative, trends,
               round(news_sentiment + 1e-9, 6) + 0.0 AS news_sentiment
        FROM fx_forecasts""",
    "sentiment_history": """
        SELECT series_id, strftime(date + 1, '%Y-%m-%d') AS date,
               count(*) FILTER (polarity = 'POSITIVE') AS total_positive,
               count(*) FILTER (polarity = 'NEGATIVE') AS total_negative
        FROM fx_posts
        WHERE media = 'twitter' AND date BETWEEN DATE '2024-01-24' AND DATE '2024-01-30'
        GROUP BY series_id, fx_posts.date""",
    "trend_history": """
        SELECT series_id, strftime(date, '%Y-%m-%d') AS date,
               CAST(round_even(trends / 2.0, 0) AS BIGINT) AS trends
        FROM fx_trends WHERE date BETWEEN DATE '2024-01-22' AND DATE '2024-01-30'""",
    "prediction_record": f"""
        SELECT series_id, date AS utc_date, date + 1 AS date, close_price AS reference_price,
               round_even(p, 2) AS tomorrow_price_up_prob, prediction AS tomorrow_prediction,
               positive AS twitter_positive_sentiment, negative AS twitter_negative_sentiment,
               round_even(news_sentiment, 2) AS news_sentiment, trends AS google_trends,
               'trends,twitter_score' AS selected_features,
               round(e.mean_acc, 6) + 0.0 AS eval_acc,
               round(e.std_acc, 6) + 0.0 AS eval_acc_7days_std,
               round(h.mean_acc, 6) + 0.0 AS holdout_eval_acc,
               round(h.std_acc, 6) + 0.0 AS holdout_eval_acc_7days_std
        FROM fx_latest LEFT JOIN {_TRAIN} e USING (series_id) LEFT JOIN {_TEST} h USING (series_id)""",
    "check_dates": f"""
        SELECT event_type, count(*) AS n, count(*) FILTER (said IS NULL) AS n_missing,
               count(*) FILTER (said IS NOT NULL AND try_cast(said AS TIMESTAMP) IS NULL)
                   AS n_invalid
        FROM fx_relative GROUP BY event_type""",
    "check_duplicate_text": """
        SELECT lang, sha256(article) AS text_sha256, count(*) AS copies
        FROM fx_articles GROUP BY lang, article HAVING count(*) > 1""",
    "check_daily_cardinality": f"""
        SELECT series_id, date, count(tweet_id) AS n
        FROM {_SPINE.format(start=_AFTER_LONG_START)} LEFT JOIN fx_order_posts
            USING (series_id, date)
        GROUP BY ALL HAVING count(tweet_id) <> 1""",
    "usable_days": """
        SELECT series_id, count(DISTINCT date) - 2 AS usable_days FROM fx_order_posts
        WHERE date <= DATE '2000-12-31' GROUP BY ALL""",
    "scan_day_csv": f"""
        SELECT date, media, title, sha256(article) AS article FROM {_DISTINCT_ARTICLES}
        WHERE date = DATE '2024-01-09'""",
    "scan_day_fallback": """
        SELECT series_id, date, o_orderkey
        FROM (SELECT o_orderpriority || '-' || (o_custkey % 50) AS series_id,
                     CAST(o_orderdate AS DATE) AS date, o_orderkey FROM orders)
        WHERE date IN (DATE '1998-03-02', DATE '1998-02-20')
        QUALIFY rank() OVER (PARTITION BY series_id ORDER BY date DESC) = 1""",
    "file_date": "SELECT date AS file_date, count(*) AS n FROM fx_close GROUP BY ALL",
    "write_by_date": _DAILY_ARTICLES.format(rows=_DISTINCT_ARTICLES),
    "write_day_overwrite": _DAILY_ARTICLES.format(
        rows="""(SELECT DISTINCT title, article, date, media FROM fx_articles
                 WHERE date < DATE '2024-01-20' OR lang = 'en'
                    OR date NOT IN (SELECT date FROM fx_articles WHERE lang = 'en'))"""
    ),
    "write_day_append": _DAILY_ARTICLES.format(
        rows=f"""(SELECT * FROM {_DISTINCT_ARTICLES} UNION ALL
                  SELECT DISTINCT title, article, date, media FROM fx_articles
                  WHERE date >= DATE '2024-01-20' AND lang = 'en')"""
    ),
    "insert_if_absent": """
        SELECT series_id, date, trends + CASE WHEN date > DATE '2024-01-20' THEN 1000 ELSE 0 END
            AS trends FROM fx_trends""",
    "upsert_by_date": """
        SELECT series_id, date,
               close_price * CASE WHEN date >= DATE '2024-01-15' THEN 2 ELSE 1 END AS close_price
        FROM fx_close""",
    "write_record_json": """
        SELECT series_id, date, round(coalesce(sum(rank), 0.0), 4) + 0.0 AS influence_score
        FROM fx_posts LEFT JOIN fx_influencers ON author = handle GROUP BY ALL""",
    "publish_tables": "SELECT * FROM fx_trends JOIN fx_close USING (series_id, date)",
    "stream_ingest": _EVENTS,
    "stream_daily_counts": """
        SELECT CAST(ts AS DATE) AS date, event_type, count(*) AS n FROM events GROUP BY ALL""",
    "stream_dedup": _EVENTS,
    "boosted_stumps": _STUMPED + """
        SELECT trial, fold_id, series_id, date, is_price_up, round(1 / (1 + exp(-margin)), 6) + 0.0 AS p
        FROM margins2 WHERE tests""",
    "stump_search": _STUMPED + """
        , judged AS (
            SELECT trial, is_price_up AS actual, 1 / (1 + exp(-margin)) > 0.5 AS predicted
            FROM margins2 WHERE tests AND is_price_up IS NOT NULL
        ), per_class AS (
            SELECT trial, class, 2.0 * count(*) FILTER (actual = predicted AND actual = class)
                / (count(*) FILTER (actual = class) + count(*) FILTER (predicted = class)) AS f1
            FROM judged, (VALUES (true), (false)) AS c(class) WHERE class IN (actual, predicted) GROUP BY trial, class
        )
        SELECT trial, round(avg(f1), 6) + 0.0 AS macro_f1 FROM per_class GROUP BY trial""",
    "batch_infer": """
        SELECT doc_id, round(1.0 / (1.0 + exp(-(length(article) - 1000.0) / 1000.0)), 6) AS p
        FROM fx_articles""",
}


#: The named entities of the generated pages that ``page_article`` leaves as they are.
_NAMED = "replace(replace({}, '&copy;', '\u00a9'), '&middot;', '\u00b7')"


def statements() -> dict[str, str]:
    """Query name to a complete statement. Model fits have none."""
    BODIES["page_markup"] = f"SELECT page_id, {_NAMED.format('headline')} AS headline, {_NAMED.format('article')} AS article FROM ({BODIES['page_article']})"
    same = {"insert_stored_days": "insert_if_absent", "upsert_stored_days": "upsert_by_date", "versioned_tables": "publish_tables"}
    return {name: with_views(body) for name, body in (BODIES | {n: BODIES[o] for n, o in same.items()}).items()}
