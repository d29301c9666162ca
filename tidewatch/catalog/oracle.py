"""The catalog's queries in SQL, written for a different engine and in a different way.

Windows come from ``time_bucket``, the detector is a recursive table expression, and the
scorer is relational: one row per word, context through ``lag``.
"""

from __future__ import annotations

from tidewatch.catalog.inputs import (
    AS_OF,
    BRANDS,
    DETECTION,
    FEED_PARTS,
    LEXICON,
    PART_EVENTS,
    PER_BRAND,
)
from tidewatch.config import Detection

_SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
_PLAIN = r"([^!-/:-@\[-`{-~]{2,})"
_RUN = r"""(?:[.!?,;:\-''"]|!!|!!!|\?\?|\?\?\?|\?!\?|!\?!|\?!\?!|!\?!\?)"""
_DAY, _SLIDE = DETECTION.window_seconds, DETECTION.slide_seconds


def _round(expression: str, places: int = 4) -> str:
    return f"CAST(printf('%.{places}f', CAST({expression} AS DOUBLE)) AS DOUBLE)"


def _values(table: str, columns: str, rows) -> str:
    literal = ", ".join("(" + ", ".join(
        f"'{x}'" if isinstance(x, str) else f"CAST({x!r} AS DOUBLE)" for x in row) + ")"
        for row in rows)
    return f"{table}({columns}) AS (VALUES {literal})"


def _clean(text: str) -> str:
    links = rf"regexp_replace({text}, 'https?://[^{_SPACE}]+', ' ', 'g')"
    marks = rf"regexp_replace({links}, '[*_>~`]+', ' ', 'g')"
    return rf"trim(regexp_replace({marks}, '[{_SPACE}]+', ' ', 'g'))"


def _strip(text: str) -> str:
    return rf"regexp_replace({text}, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g')"


_T = LEXICON.turns


def _so(d: int) -> str:
    return f"coalesce(plain{d} IN {_T.so}, false)"


def _strong(d: int) -> str:
    never = f"coalesce(plain{d} = '{_T.never}', false)"
    return {1: "false", 2: f"{never} AND {_so(1)}", 3: f"({never} AND {_so(2)}) OR {_so(1)}"}[d]


def _kept(d: int) -> str:
    first, second = _T.without
    own = " OR ".join(f"plain{n} = '{second}'" for n in range(1, d)) or "false"
    return f"plain{d} = '{first}' AND ({own})"


def _phrase(words: str) -> str:
    return f"(SELECT valence FROM phrases WHERE words = {words})"


# Scoring: expects a table expression ``texts(k, text)``, gives ``polarity(k, compound, neg, neu, pos)``.

_SCORING = ",\n".join([
    _values("lexicon", "word, valence", LEXICON.scored.items()),
    _values("degrees", "word, degree", LEXICON.degrees.items()),
    _values("negators", "word", [(w,) for w in LEXICON.negators]),
    _values("phrases", "words, valence", LEXICON.phrases.items()),
    rf"""split_words AS (
      SELECT k, list_filter(regexp_split_to_array(text, '[{_SPACE}]+'), lambda w: length(w) > 1) AS ws
      FROM texts)""",
    rf"""word_rows AS (
      SELECT k, w, pos, lower(b) AS plain, w = upper(w) AND w <> lower(w) AS loud,
             b = upper(b) AND b <> lower(b) AS bare_loud
      FROM (SELECT k, w, pos, regexp_replace(w, '^(?:{_RUN}{_PLAIN}|{_PLAIN}{_RUN})$', '\1\2') AS b
            FROM (SELECT k, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM split_words)))""",
    """context AS (
      SELECT r.*, l.valence, d.degree, l.word IS NOT NULL OR d2.word IS NOT NULL AS known,
             n.word IS NOT NULL OR contains(plain, 'n''t') AS negates,
             count(*) FILTER (WHERE loud) OVER (PARTITION BY k) AS loud_words,
             count(*) OVER (PARTITION BY k) AS n_words,
             min(pos) FILTER (WHERE plain = 'but') OVER (PARTITION BY k) AS turn
      FROM word_rows r
      LEFT JOIN lexicon l ON l.word = r.plain
      LEFT JOIN (SELECT word FROM lexicon) d2 ON d2.word = r.plain
      LEFT JOIN degrees d ON d.word = r.plain
      LEFT JOIN negators n ON n.word = r.plain)""",
    """around AS (
      SELECT *, loud_words > 0 AND loud_words < n_words AS stands_out,
             """ + ",\n             ".join(
        f"lag({c}, {d}) OVER (PARTITION BY k ORDER BY pos) AS {c}{d}"
        for d in (1, 2, 3) for c in ("plain", "known", "degree", "negates", "bare_loud")) + """,
             lead(plain) OVER (PARTITION BY k ORDER BY pos) AS next1,
             lead(plain, 2) OVER (PARTITION BY k ORDER BY pos) AS next2
      FROM context)""",
    """step0 AS (
      SELECT *, valence + CASE WHEN stands_out AND bare_loud THEN sign(valence) * 0.733::DOUBLE ELSE 0 END AS v0
      FROM around WHERE valence IS NOT NULL)""",
    *[f"""step{d} AS (
      SELECT *, CASE WHEN plain{d} IS NULL OR known{d} THEN v{d - 1}
             ELSE (v{d - 1} + coalesce((degree{d} * CASE WHEN v{d - 1} < 0 THEN -1 ELSE 1 END
                   + CASE WHEN stands_out AND bare_loud{d}
                          THEN CASE WHEN v{d - 1} > 0 THEN 0.733::DOUBLE ELSE -0.733::DOUBLE END
                          ELSE 0 END) * {damp}::DOUBLE, 0))
                  * CASE WHEN {_strong(d)} THEN {_T.stronger}::DOUBLE WHEN {_kept(d)} THEN 1
                         WHEN negates{d} THEN -0.74::DOUBLE ELSE 1 END END AS v{d}
      FROM step{d - 1})""" for d, damp in ((1, "1.0"), (2, "0.95"), (3, "0.9"))],
    f"""phrased AS (
      SELECT s.k, pos, turn, plain1, plain2, known1,
             CASE WHEN plain3 IS NULL OR known3 THEN v3
             ELSE coalesce({_phrase("plain || ' ' || next1 || ' ' || next2")}, {_phrase("plain || ' ' || next1")},
                           {_phrase("plain1 || ' ' || plain")}, {_phrase("plain2 || ' ' || plain1 || ' ' || plain")},
                           {_phrase("plain2 || ' ' || plain1")}, {_phrase("plain3 || ' ' || plain2 || ' ' || plain1")},
                           {_phrase("plain3 || ' ' || plain2")}, v3)
                  + {" + ".join(f"coalesce((SELECT degree FROM degrees WHERE word = {w}), 0)" for w in (
                      "plain3 || ' ' || plain2 || ' ' || plain1", "plain3 || ' ' || plain2", "plain2 || ' ' || plain1"))}
             END AS v4
      FROM step3 s)""",
    f"""turned AS (
      SELECT *, v4 * CASE WHEN plain1 = '{_T.least}' AND NOT known1
                               AND NOT coalesce(plain2 IN {_T.not_least}, false)
                          THEN -0.74::DOUBLE ELSE 1 END AS v5
      FROM phrased)""",
    """weighed AS (
      SELECT k, pos, v5 * CASE WHEN turn IS NULL OR pos = turn THEN 1.0
                               WHEN pos < turn THEN 0.5 ELSE 1.5 END::DOUBLE AS v
      FROM turned)""",
    """sums AS (
      SELECT k, sum(v ORDER BY pos) AS total, coalesce(sum(v + 1 ORDER BY pos) FILTER (WHERE v > 0), 0) AS up,
             coalesce(sum(1 - v ORDER BY pos) FILTER (WHERE v < 0), 0) AS down,
             count(*) FILTER (WHERE v <> 0) AS felt
      FROM weighed GROUP BY k)""",
    """emphasis AS (
      SELECT t.k, len(s.ws) AS n_words, coalesce(total, 0) AS total, coalesce(up, 0) AS up,
             coalesce(down, 0) AS down, len(s.ws) - coalesce(felt, 0) AS flat,
             least(length(text) - length(replace(text, '!', '')), 4) * 0.292::DOUBLE
             + CASE WHEN q > 3 THEN 0.96::DOUBLE WHEN q > 1 THEN q * 0.18::DOUBLE ELSE 0 END AS push
      FROM (SELECT *, length(text) - length(replace(text, '?', '')) AS q FROM texts) t
      JOIN split_words s ON s.k = t.k LEFT JOIN sums ON sums.k = t.k)""",
    """shares AS (
      SELECT k, n_words, total + sign(total) * push AS total, flat,
             up + CASE WHEN up > down THEN push ELSE 0 END AS rise,
             down + CASE WHEN up < down THEN push ELSE 0 END AS fall
      FROM emphasis)""",
    f"""polarity AS (
      SELECT k,
             CASE WHEN n_words > 0 THEN {_round('total / sqrt(total * total + 15)')} ELSE 0 END AS compound,
             CASE WHEN n_words > 0 THEN {_round('fall / (rise + fall + flat)', 3)} ELSE 0 END AS neg,
             CASE WHEN n_words > 0 THEN {_round('flat / (rise + fall + flat)', 3)} ELSE 0 END AS neu,
             CASE WHEN n_words > 0 THEN {_round('rise / (rise + fall + flat)', 3)} ELSE 0 END AS pos
      FROM shares)""",
    f"""verdicts AS (
      SELECT *, CASE WHEN compound <= -0.05 THEN 'neg' WHEN compound >= 0.05 THEN 'pos' ELSE 'neu' END AS label,
             CASE WHEN compound <= -0.3 THEN 'neg' WHEN compound >= 0.3 THEN 'pos' ELSE 'neu' END AS weak,
             {_round('CASE WHEN compound < 0 THEN neg ELSE neg * 0.3::DOUBLE END')} AS neg_prob,
             CASE WHEN compound = 0 THEN 1.0 ELSE abs(compound) END AS confidence
      FROM polarity)""",
])


def _scored(texts: str, rest: str, *more: str) -> str:
    """A query over ``verdicts`` for the texts that the query ``texts`` gives."""
    return "WITH RECURSIVE " + ",\n".join([f"texts AS MATERIALIZED ({texts})", _SCORING, *more]) + "\n" + rest


_DOCUMENTS = "SELECT doc_id AS k, text FROM documents"

_EVENT_MESSAGES = """event_messages AS (
      SELECT CAST(event_id AS VARCHAR) AS id, event_type AS brand, 'user_' || user_id AS author,
             CAST(trunc(value) AS INTEGER) AS score, ts AS event_time,
             event_id % (SELECT count(*) FROM documents) AS doc_id
      FROM events)"""
_SCORED_MESSAGES = """scored AS MATERIALIZED (
      SELECT m.*, left(t.text, 280) AS sample, v.label, v.neg_prob
      FROM event_messages m JOIN texts t ON t.k = m.doc_id JOIN verdicts v ON v.k = m.doc_id)"""


def _aggregate(name: str, where: str = "true") -> str:
    return f"""{name} AS MATERIALIZED (
      SELECT brand, epoch(w) AS window_start, epoch(w) + {_DAY} AS window_end, count(*) AS volume,
             count(*) FILTER (WHERE label = 'neg') AS neg_count,
             {_round("count(*) FILTER (WHERE label = 'neg') / count(*)")} AS neg_ratio,
             {_round("CAST(sum(CAST(neg_prob AS DECIMAL(18, 9))) AS DOUBLE) / count(*)")} AS avg_neg_prob,
             count(DISTINCT author) AS unique_authors,
             {_round("sum(neg_prob * ln(1 + greatest(score, 0)))")} AS influencer_neg,
             first(sample ORDER BY neg_prob DESC, epoch_us(event_time) // 1000, id)
               FILTER (WHERE neg_prob > 0) AS sample_text
      FROM (SELECT *, time_bucket(INTERVAL '{_SLIDE} seconds', event_time, TIMESTAMP '1970-01-01')
                      - to_seconds({_SLIDE} * i) AS w
            FROM scored, range({_DAY // _SLIDE}) steps(i) WHERE {where})
      GROUP BY brand, w)"""


_WINDOWS = (_EVENT_MESSAGES, _SCORED_MESSAGES, _aggregate("windows"))
_CLEAN_FREE = "SELECT doc_id AS k, coalesce(text, '') AS text FROM documents"
_CLEAN_DOCUMENTS = f"SELECT * FROM (SELECT doc_id AS k, {_clean('text')} AS text FROM documents) WHERE length(text) >= 5"


def _detector(source: str, detection: Detection) -> tuple[str, ...]:
    """``flagged``: the windows of ``source`` with ``z`` and ``alert``."""
    base = detection.thresholds

    def limit(name: str) -> str:
        own = " ".join(f"WHEN '{b}' THEN {getattr(t, name)}" for b, t in detection.per_brand.items())
        default = f"{getattr(base, name)}"
        value = f"CASE n.brand {own} ELSE {default} END" if own else default
        return f"CAST({value} AS DOUBLE)"

    z = "CASE WHEN n.rn > 5 AND sqrt(f.var) > 1e-6 THEN (n.neg_count - f.mean) / sqrt(f.var) ELSE 0 END"
    passes = (f"z >= {limit('spike_k')} AND volume >= {limit('min_volume')} "
              f"AND neg_ratio >= {limit('min_neg_ratio')} "
              f"AND (last_end IS NULL OR window_end - last_end >= {limit('cooldown_seconds')})")
    return (
        f"""numbered AS MATERIALIZED (
      SELECT *, row_number() OVER (PARTITION BY brand ORDER BY window_start) AS rn FROM {source})""",
        f"""flagged AS (
      SELECT brand, rn, window_start, window_end, volume, neg_count, neg_ratio, sample_text,
             CAST(neg_count AS DOUBLE) AS mean, CAST(0 AS DOUBLE) AS var, CAST(0 AS DOUBLE) AS z,
             false AS alert, CAST(NULL AS DOUBLE) AS last_end
      FROM numbered WHERE rn = 1
      UNION ALL
      SELECT brand, rn, window_start, window_end, volume, neg_count, neg_ratio, sample_text, mean, var,
             z, {passes} AS alert, CASE WHEN {passes} THEN window_end ELSE last_end END
      FROM (SELECT n.*, f.last_end, {z} AS z,
                   f.mean + {limit('alpha')} * (n.neg_count - f.mean) AS mean,
                   (1 - {limit('alpha')}) * (f.var + {limit('alpha')} * (n.neg_count - f.mean)
                     * (n.neg_count - f.mean)) AS var
            FROM flagged f JOIN numbered n ON n.brand = f.brand AND n.rn = f.rn + 1) n)""",
        f"""alerts AS (
      SELECT brand, window_end AS triggered_at, window_start, window_end, {_round('z')} AS z_score,
             neg_ratio, volume,
             CASE WHEN z >= 6 THEN 'critical' WHEN z >= 4.5 THEN 'high' WHEN z >= 3 THEN 'medium'
                  ELSE 'low' END AS severity, sample_text
      FROM flagged WHERE alert)""",
        """alert_table AS (
      SELECT CAST('0x' || left(md5(brand || '|' || CAST(CAST(window_end * 1000 AS BIGINT) AS VARCHAR)), 15)
                  AS BIGINT) AS id,
             brand, triggered_at, window_start, window_end,
             CAST(CAST(z_score AS FLOAT) AS DOUBLE) AS z_score,
             CAST(CAST(neg_ratio AS FLOAT) AS DOUBLE) AS neg_ratio, volume, severity, sample_text
      FROM alerts)""",
    )


def _over_windows(rest: str, *more: str) -> str:
    return _scored(_CLEAN_DOCUMENTS, rest, *_WINDOWS, *more)


def _over_alerts(rest: str, detection: Detection = DETECTION, source: str = "windows", *more: str) -> str:
    return _over_windows(rest, *more, *_detector(source, detection))


_FLOATS = ("CAST(CAST(neg_ratio AS FLOAT) AS DOUBLE) AS neg_ratio, "
           "CAST(CAST(avg_neg_prob AS FLOAT) AS DOUBLE) AS avg_neg_prob, "
           "unique_authors, CAST(CAST(influencer_neg AS FLOAT) AS DOUBLE) AS influencer_neg")
_NOW = f"epoch(TIMESTAMP '{AS_OF}')"
_SERIES = (f"""series AS (
      SELECT window_start, window_end, volume, neg_count, {_FLOATS} FROM windows
      WHERE brand = 'click' AND window_start >= {_NOW} - 1440 * 60)""")
_CLOSED = f"""closed AS MATERIALIZED (
      SELECT * FROM windows
      WHERE window_end <= (SELECT (epoch_us(max(ts)) // 1000) / 1000.0 FROM events) - {DETECTION.lateness_seconds})"""
_SPAN = f"""span AS (
      SELECT min(epoch_us(ts) // 1000) AS low, max(epoch_us(ts) // 1000) AS high,
             greatest({FEED_PARTS}, (count(*) + {PART_EVENTS - 1}) // {PART_EVENTS}) AS parts
      FROM events)"""


def _part(ms: str) -> str:
    return f"(({ms} - (SELECT low FROM span)) * (SELECT parts FROM span) // (SELECT high - low + 1 FROM span))"


# Rows of the two topics: the second lacks its last part.
_DELIVERED = (f"brand IN ('view', 'click') OR {_part('epoch_us(event_time) // 1000')} "
              "< (SELECT parts - 1 FROM span)")
_LAGGING = f"""lagging AS (
      SELECT * FROM delivered
      WHERE window_end * 1000 <= (
        SELECT min(ms) FROM (SELECT max(epoch_us(event_time) // 1000) AS ms FROM scored WHERE {_DELIVERED}
                             GROUP BY brand IN ('view', 'click'))) - {DETECTION.lateness_seconds * 1000})"""
_SIGN = ("CASE severity WHEN 'low' THEN '🟡' WHEN 'medium' THEN '🟠' WHEN 'high' THEN '🔴' "
         "WHEN 'critical' THEN '🚨' ELSE '⚠️' END")


def _brand_case() -> str:
    word, other = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"

    def pattern(keyword: str) -> str:
        first, last = keyword[0].isalnum(), keyword[-1].isalnum()
        left = rf"(?:^|{other})" if first else word
        right = rf"(?:$|{other})" if last else word
        escaped = "".join(c if c.isalnum() or c in " /&%" else "\\" + c for c in keyword)
        return left + escaped + right

    cases = " ".join(
        "WHEN regexp_matches(lower(text), '" + "|".join(map(pattern, b.keywords)) + f"') THEN '{b.name}'"
        for b in BRANDS)
    return f"CASE {cases} END"


_LABELLED = """labelled AS (
      SELECT d.doc_id AS row_id, d.text,
             CASE WHEN toxic = 1 THEN 'neg' WHEN quality = 1 THEN 'pos' ELSE 'neu' END AS label
      FROM documents d JOIN labels USING (doc_id))"""
_TURNS = f"""SELECT conv_id * 1000000 + turn AS k, {_strip("CASE WHEN text <> '' THEN text ELSE role END")} AS text
      FROM conversations"""
_LONG_TURNS = f"SELECT * FROM ({_TURNS}) WHERE length(text) >= 8"
_CORPUS = (
    _LABELLED,
    """parts AS (
      SELECT row_id, text, label, 'public' AS source FROM labelled
      UNION ALL
      SELECT t.k, t.text, v.weak, 'reddit_weak' FROM texts t JOIN verdicts v USING (k))""",
    """once AS (
      SELECT * FROM (SELECT *, row_number() OVER (
                       PARTITION BY text ORDER BY source <> 'public', row_id, label) AS copy FROM parts)
      WHERE copy = 1)""",
    """corpus AS (
      SELECT text, label, source,
             CASE WHEN rn <= CAST(floor(n * 0.8::DOUBLE) AS BIGINT) THEN 'train'
                  WHEN rn <= CAST(floor(n * 0.8::DOUBLE) AS BIGINT) + CAST(floor(n * 0.1::DOUBLE) AS BIGINT)
                  THEN 'val' ELSE 'test' END AS split
      FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || text)) AS rn, count(*) OVER () AS n FROM once))""",
)


def _metrics(name: str, predicted: str) -> str:
    return f"""{name} AS (
      SELECT avg(CASE WHEN label = {predicted} THEN 1.0 ELSE 0.0 END)::DOUBLE AS accuracy,
             (SELECT avg(f1) FROM (
                SELECT 2.0 * count(*) FILTER (WHERE label = c AND {predicted} = c)
                       / (count(*) FILTER (WHERE label = c) + count(*) FILTER (WHERE {predicted} = c)) AS f1
                FROM predictions, (SELECT label AS c FROM predictions UNION SELECT {predicted} FROM predictions)
                GROUP BY c)) AS f1_macro,
             count(*) AS n
      FROM predictions)"""


_PREDICTIONS = """predictions AS MATERIALIZED (
      SELECT l.label, v.label AS predicted, v.weak FROM labelled l JOIN verdicts v ON v.k = l.row_id)"""
_LABELLED_TEXTS = "SELECT doc_id AS k, text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"

_TYPED = """typed AS (
      SELECT CAST(event_id AS VARCHAR) AS id, event_type AS brand,
             CAST(trunc(value) AS INTEGER) AS score,
             CASE WHEN CAST(trunc(value) AS INTEGER) > 20 THEN 'submission' ELSE 'comment' END AS type
      FROM events JOIN documents ON doc_id = event_id % (SELECT count(*) FROM documents))"""


def oracle_sql() -> dict[str, str]:
    return {
        "message_view": f"""WITH {_EVENT_MESSAGES}
            SELECT id, brand, author, score, epoch_us(event_time) // 1000 AS event_ms, md5(text) AS body_md5
            FROM event_messages JOIN documents USING (doc_id)""",
        "normalise_records": """
            SELECT 'e' || event_id AS id,
                   CASE event_type WHEN 'view' THEN 'comment' WHEN 'click' THEN 'comment'
                        ELSE 'submission' END AS type,
                   'unknown' AS subreddit,
                   CASE WHEN event_type <> 'view' THEN 'user_' || user_id END AS author,
                   event_type AS brand, CASE WHEN event_type = 'purchase' THEN props END AS title,
                   CASE WHEN event_type = 'view' THEN '' ELSE props END AS body,
                   CAST(CASE event_type WHEN 'view' THEN trunc(value) WHEN 'purchase' THEN -trunc(value)
                        ELSE 0 END AS BIGINT) AS score,
                   floor(epoch(ts)) AS created_utc
            FROM events""",
        "live_items": """
            SELECT 'd' || doc_id AS id, 'submission' AS type, source AS subreddit, NULL AS author,
                   lang AS brand, source AS title, n_chars AS score, NULL AS parent_id,
                   CAST(doc_id AS DOUBLE) AS created_utc, md5(text) AS body_md5 FROM documents
            UNION ALL
            SELECT conv_id || '-' || turn, 'comment', role, role, role, NULL, 0, CAST(conv_id AS VARCHAR),
                   CAST(turn AS DOUBLE), md5(text) FROM conversations""",
        "dump_folder_scan": """
            SELECT conv_id || '-' || turn AS id,
                   CASE WHEN role = 'system' THEN 'submission' ELSE 'comment' END AS type, role AS author,
                   CASE WHEN role = 'system' THEN role END AS title, md5(text) AS body_md5,
                   turn AS score, CAST(conv_id + 1 AS DOUBLE) AS created_utc
            FROM conversations""",
        "zstd_frames_scan": """
            SELECT conv_id || '-' || turn AS id,
                   CASE WHEN role = 'system' THEN 'submission' ELSE 'comment' END AS type, role AS author,
                   CASE WHEN role = 'system' THEN role END AS title, md5(text) AS body_md5,
                   turn AS score, CAST(conv_id + 1 AS DOUBLE) AS created_utc
            FROM conversations""",
        "json_drop_malformed": """
            SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
            WHERE event_type IN ('view', 'purchase')""",
        "bot_filter": """
            SELECT conv_id, turn, CASE WHEN turn = 2 THEN 'botanist' WHEN turn = 3 THEN '  '
                                       WHEN turn > 3 THEN NULL ELSE role END AS author
            FROM conversations WHERE role <> 'system' AND turn <> 1""",
        "brand_match": f"SELECT doc_id, {_brand_case()} AS brand FROM documents",
        "brand_match_large": f"""SELECT doc_id, {_brand_case()} AS brand FROM documents
            WHERE {_brand_case()} IS NOT NULL""",
        "brand_counters": f"""
            SELECT count({_brand_case()}) AS sent, count(*) - count({_brand_case()}) AS skipped
            FROM documents""",
        "clean_text": f"""
            SELECT doc_id, length(t) AS characters, md5(t) AS text_md5, left(t, 512) AS message_text
            FROM (SELECT doc_id, {_clean('text')} AS t FROM documents) WHERE length(t) >= 5""",
        "lexicon_polarity": _scored(_DOCUMENTS, """
            SELECT k AS doc_id, compound, neg, neu, pos, label, neg_prob, confidence FROM verdicts"""),
        "label_counts": _scored(_DOCUMENTS, """
            SELECT lang, label, count(*) AS rows FROM verdicts JOIN documents ON doc_id = k GROUP BY ALL"""),
        "weak_labels": _scored(_LONG_TURNS, """
            SELECT k // 1000000 AS conv_id, k % 1000000 AS turn, left(text, 512) AS text, weak AS label,
                   'reddit_weak' AS source
            FROM verdicts JOIN texts USING (k)"""),
        "first_weak_rows": _scored(f"{_LONG_TURNS} ORDER BY k LIMIT 100", """
            SELECT k // 1000000 AS conv_id, k % 1000000 AS turn, weak AS label FROM verdicts"""),
        "softmax_argmax": f"""
            WITH p AS (SELECT vec_id, exp(a) / (exp(a) + exp(b) + exp(c)) AS p1,
                              exp(b) / (exp(a) + exp(b) + exp(c)) AS p2,
                              exp(c) / (exp(a) + exp(b) + exp(c)) AS p3
                       FROM (SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b,
                                    embedding[3]::DOUBLE AS c FROM embeddings))
            SELECT vec_id, CASE WHEN p1 >= p2 AND p1 >= p3 THEN 'neg' WHEN p2 >= p3 THEN 'neu' ELSE 'pos' END
                   AS label, {_round('p1', 9)} AS neg_prob, {_round('greatest(p1, p2, p3)', 9)} AS confidence
            FROM p""",
        "scored_records": _scored(f"""
            SELECT conv_id * 1000000 + turn AS k, t AS text
            FROM (SELECT *, {_clean("concat_ws(' ', nullif(role, ''), nullif(text, ''))")} AS t
                  FROM conversations)
            WHERE length(t) >= 5""", """
            SELECT k // 1000000 AS conv_id, k % 1000000 AS turn, left(text, 512) AS text, label, neg_prob
            FROM verdicts JOIN texts USING (k)"""),
        "sliding_aggregates": _over_windows("SELECT * FROM windows"),
        "stored_aggregates": _over_windows("SELECT * FROM windows"),
        "ewma_zscore": _over_alerts(f"""
            SELECT brand, window_start, neg_count, {_round('z', 6)} AS z_score FROM flagged"""),
        "spike_alerts": _over_alerts("SELECT * FROM alerts"),
        "spike_alerts_per_brand": _over_alerts("SELECT * FROM alerts", PER_BRAND),
        "stream_aggregates": _over_windows("SELECT * FROM closed", _CLOSED),
        "stream_alerts": _over_alerts("SELECT * FROM alerts", DETECTION, "closed", _CLOSED),
        "stream_two_topics": _over_windows(
            "SELECT * FROM lagging", _SPAN, _aggregate("delivered", _DELIVERED), _LAGGING),
        "late_rows": f"""WITH {_SPAN}, fed AS (
              SELECT event_type AS brand, CAST(event_id AS VARCHAR) AS id, epoch_us(ts) // 1000 AS ms,
                     least({_part('epoch_us(ts) // 1000')} + (event_id % 5 = 0)::INT,
                           (SELECT parts - 1 FROM span)) AS file
              FROM events JOIN documents ON doc_id = event_id % (SELECT count(*) FROM documents)),
            files AS (
              SELECT file, max(max(ms)) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                           - {DETECTION.lateness_seconds * 1000} AS watermark
              FROM fed GROUP BY file),
            starts AS (
              SELECT fed.*, watermark, CAST((ms // {_SLIDE * 1000} - i) * {_SLIDE} AS DOUBLE) AS window_start
              FROM fed JOIN files USING (file), range({_DAY // _SLIDE}) steps(i))
            SELECT brand, id, ms AS at, window_start FROM starts WHERE (window_start + {_DAY}) * 1000 <= watermark""",
        "route_by_type": f"""WITH {_TYPED}
            SELECT type || 's' AS topic, brand AS key, count(*) AS messages, max(id) AS last_id,
                   CAST(sum(score) AS BIGINT) AS scores
            FROM typed GROUP BY ALL""",
        "contract_rejects": f"""WITH {_TYPED}
            SELECT CASE brand WHEN 'error' THEN 'type is one of submission, comment'
                              WHEN 'view' THEN 'id is required; created_utc is after the epoch'
                              WHEN 'signup' THEN 'brand is required' ELSE '' END AS violations,
                   count(*) AS messages
            FROM typed GROUP BY ALL""",
        "upsert_aggregates": _over_windows(f"""
            SELECT brand, window_start, window_end, volume, neg_count, {_FLOATS} FROM late
            UNION ALL
            SELECT brand, window_start, window_end, volume, neg_count, {_FLOATS}
            FROM early ANTI JOIN late USING (brand, window_start)""",
            _aggregate("early", f"event_time < TIMESTAMP '{AS_OF}'"),
            _aggregate("late", f"event_time >= TIMESTAMP '{AS_OF}'")),
        "append_alerts": _over_alerts(
            "SELECT id, brand, triggered_at, volume, severity, sample_text FROM alert_table"),
        "upsert_revisions": _over_windows("SELECT brand, window_start, volume, neg_count FROM windows"),
        "persisted_records": _over_alerts("""
            SELECT 'aggregates' AS place, count(*) AS records FROM windows
            UNION ALL SELECT 'alerts', count(*) FROM alerts
            UNION ALL SELECT 'aggregates: record is a JSON object', count(*) FROM windows WHERE volume % 3 = 0
            UNION ALL SELECT 'aggregates: brand is required', count(*) FROM windows WHERE volume % 3 = 1
            UNION ALL SELECT 'alerts: brand is required', count(*) FROM alerts"""),
        "known_brands": "SELECT DISTINCT event_type AS brand FROM events ORDER BY brand",
        "brand_series": _over_windows("SELECT * FROM series ORDER BY window_start", _SERIES),
        "brand_trend": _over_windows("""
            SELECT window_start, 'counts' AS chart, 'volume' AS measure, volume::DOUBLE AS value FROM series
            UNION ALL SELECT window_start, 'counts', 'neg_count', neg_count::DOUBLE FROM series
            UNION ALL SELECT window_start, 'ratios', 'neg_ratio', neg_ratio FROM series
            UNION ALL SELECT window_start, 'ratios', 'avg_neg_prob', avg_neg_prob FROM series""", _SERIES),
        "brand_window_count": _over_windows("SELECT count(*) AS windows FROM series", _SERIES),
        "latest_alerts": _over_alerts(
            "SELECT * FROM alert_table ORDER BY triggered_at DESC, id LIMIT 20"),
        "active_alerts": _over_alerts(f"""
            SELECT * FROM alert_table WHERE triggered_at >= {_NOW} - 3600"""),
        "alert_headlines": _over_alerts(f"""
            SELECT id, triggered_at, {_SIGN} || ' **' || brand || '** — z=' || printf('%.2f', z_score)
                   || ', neg_ratio=' || printf('%.2f', neg_ratio) || ', volume=' || volume AS headline,
                   sample_text
            FROM alert_table WHERE triggered_at >= {_NOW} - 3600
            ORDER BY triggered_at DESC, id LIMIT 10"""),
        "recent_alert_table": _over_alerts("""
            SELECT triggered_at, brand, severity, z_score, neg_ratio, volume, sample_text
            FROM alert_table ORDER BY triggered_at DESC, id LIMIT 50"""),
        "corpus_build": _scored(_LONG_TURNS, "SELECT * FROM corpus", *_CORPUS),
        "corpus_stats": _scored(_LONG_TURNS, """
            SELECT split, label, count(*) AS label_count,
                   (SELECT count(*) FROM corpus c WHERE c.split = corpus.split) AS rows,
                   (SELECT count(*) FROM corpus) AS total
            FROM corpus GROUP BY split, label""", *_CORPUS),
        "written_corpus": _scored(_LONG_TURNS, """
            SELECT split, label, count(*) AS label_count,
                   (SELECT count(*) FROM corpus c WHERE c.split = corpus.split) AS rows,
                   (SELECT count(*) FROM corpus) AS total
            FROM corpus GROUP BY split, label""", *_CORPUS),
        "held_out_split": _scored(
            _LONG_TURNS, "SELECT md5(text) AS text_md5, label, source FROM corpus WHERE split = 'test'", *_CORPUS),
        "chosen_scorers": _scored(_CLEAN_FREE, """
            SELECT doc_id, 'rules' AS scorer, CASE WHEN doc_id % 7 = 0 THEN 'neu' ELSE label END AS label
            FROM documents JOIN verdicts ON k = doc_id
            UNION ALL SELECT doc_id, 'absent', 'neu' FROM documents"""),
        "whole_monitor": _over_alerts("""
            SELECT 'window' AS kind, brand, window_start AS second, volume,
                   CAST(unique_authors AS VARCHAR) AS more FROM closed
            UNION ALL SELECT 'alert', brand, triggered_at, volume, severity FROM alerts""",
            DETECTION, "closed", _CLOSED),
        "public_sample": f"""WITH {_LABELLED}
            SELECT row_id, label FROM labelled ORDER BY md5('42:' || row_id) LIMIT 200""",
        "exact_event_split": """
            SELECT event_id, CASE WHEN rn <= CAST(floor(n * 0.8::DOUBLE) AS BIGINT) THEN 'train'
                                  WHEN rn <= CAST(floor(n * 0.8::DOUBLE) AS BIGINT)
                                             + CAST(floor(n * 0.1::DOUBLE) AS BIGINT) THEN 'val'
                                  ELSE 'test' END AS split
            FROM (SELECT event_id, row_number() OVER (ORDER BY md5('42:' || event_id)) AS rn,
                         count(*) OVER () AS n FROM events)""",
        "seeded_order": """
            SELECT event_id, row_number() OVER (ORDER BY md5('42:' || event_id)) AS position FROM events""",
        "first_messages": f"""WITH {_EVENT_MESSAGES}
            SELECT id, author, score FROM event_messages WHERE brand = 'error'
            ORDER BY event_time, id LIMIT 100""",
        "batch_scoring": _scored(_LABELLED_TEXTS, """
            SELECT label, predicted, count(*) AS rows FROM predictions GROUP BY ALL""",
            _LABELLED, _PREDICTIONS),
        "quality_metrics": _scored(_LABELLED_TEXTS, f"""
            SELECT {_round('accuracy', 9)} AS accuracy, {_round('f1_macro', 9)} AS f1_macro, n FROM now""",
            _LABELLED, _PREDICTIONS, _metrics("now", "predicted")),
        "kept_baseline": _scored(_LABELLED_TEXTS, f"""
            SELECT {_round('accuracy', 9)} AS accuracy, {_round('f1_macro', 9)} AS f1_macro, n FROM now""",
            _LABELLED, _PREDICTIONS, _metrics("now", "predicted")),
        "quality_gate": _scored(_LABELLED_TEXTS, f"""
            SELECT now.n, {_round('now.f1_macro - before.f1_macro', 9)} AS delta, verdict,
                   verdict = 'improved' AS save, CASE verdict WHEN 'regression' THEN 2 ELSE 0 END AS exit_code
            FROM now, before, (SELECT CASE WHEN d < -0.01 THEN 'regression' WHEN d > 0 THEN 'improved'
                                           ELSE 'kept' END AS verdict
                               FROM (SELECT now.f1_macro - before.f1_macro AS d FROM now, before))""",
            _LABELLED, _PREDICTIONS, _metrics("now", "predicted"), _metrics("before", "weak")),
    }
