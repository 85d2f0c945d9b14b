"""The registered queries as SQL over the same tables, for an independent engine.

Text rules are written step by step here, whereas the Spark expressions merge steps.
"""

from __future__ import annotations

from chatterscope import schema

W = r"[\p{L}\p{N}_]"
WS = r"\t-\r\x1c-\x1f\x85\p{Z}"

POSTS = """
posts AS (
  SELECT e.event_id AS post_id,
    CASE WHEN e.event_id % 101 = 0 THEN NULL ELSE
      CASE WHEN e.event_id % 97 <> 0 AND e.event_id % 5 = 1 THEN 'RT @user' || CAST(
        e.user_id - e.user_id % 15 + (e.event_id * 7) % 15 AS VARCHAR) || ': ' ELSE '' END
      || d.text
      || CASE e.event_id % 6 WHEN 0 THEN ' great' WHEN 1 THEN ' terrible' WHEN 2 THEN ' good'
         WHEN 3 THEN ' not bad' ELSE '' END
      || CASE e.event_id % 7 WHEN 0 THEN ' #AI' WHEN 1 THEN ' #tech #AI' WHEN 2 THEN ' #music!'
         WHEN 3 THEN ' #Café2025' ELSE '' END
      || CASE e.event_id % 11 WHEN 0 THEN ' #NYC' WHEN 1 THEN ' #London'
         WHEN 2 THEN ' #Bombay #Mumbai' WHEN 3 THEN ' #Bengaluru' ELSE '' END
      || CASE WHEN e.event_id % 97 <> 0 AND e.event_id % 3 = 0 THEN ' @user' || CAST(
         e.user_id - e.user_id % 15 + (e.event_id * 13) % 15 AS VARCHAR) ELSE '' END
      || CASE WHEN e.event_id % 97 <> 0 AND e.event_id % 499 = 0
         THEN ' @solo' || CAST(e.event_id AS VARCHAR) ELSE '' END
      || CASE WHEN e.event_id % 8 = 0 THEN ' cities and mice' ELSE '' END
      || CASE WHEN e.event_id % 13 = 0
         THEN ' https://t.co/x' || CAST(e.event_id AS VARCHAR) ELSE '' END
    END AS text,
    e.ts AS ts, e.user_id AS author_id,
    CASE WHEN e.event_id % 97 = 0 THEN '0' WHEN e.event_id % 89 = 0 THEN NULL
      ELSE 'user' || CAST(e.user_id AS VARCHAR) END AS username,
    CASE WHEN e.event_id % 53 = 0 THEN 'N/A'
      ELSE CAST((e.event_id * 37 + e.user_id * 11) % 101 AS VARCHAR) END AS likes,
    CASE WHEN e.event_id % 59 = 0 THEN NULL
      ELSE CAST((e.event_id * 17 + e.user_id) % 41 AS VARCHAR) END AS retweets,
    CAST((e.event_id * 5) % 13 AS VARCHAR) AS replies,
    CAST(e.event_id % 4 AS VARCHAR) AS quotes,
    d.lang AS lang
  FROM (SELECT *, event_id % (SELECT COUNT(*) FROM documents) AS doc_id FROM events) e
  JOIN documents d ON d.doc_id = e.doc_id
)"""

USERS = """
users AS (
  SELECT c_custkey + 25 AS id, 'user' || CAST(c_custkey + 25 AS VARCHAR) AS username,
    (c_custkey * 13) % 1000 AS followers, (c_custkey * 7) % 500 AS following,
    c_custkey * 3 AS total_posts
  FROM customer
)"""


def _strings(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def replace(c: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({c}, '{pattern}', '{by}', 'g')"


def clean(c: str, ascii_only: bool = False) -> str:
    step = replace(c, rf"http[^{WS}]+|www[^{WS}]+|https[^{WS}]+")
    step = replace(step, rf"@{W}+|#")
    step = replace(step, rf"[^\p{{L}}\p{{N}}_{WS}]")
    step = replace(step, r"\p{Nd}+")
    if ascii_only:
        step = replace(step, r"[^\x00-\x7F]")
    step = replace(f"lower({step})", f"^[{WS}]+|[{WS}]+$")
    return f"coalesce({replace(step, f'[{WS}]+', ' ')}, '')"


def names_after(c: str, sign: str) -> str:
    return f"coalesce(regexp_extract_all({c}, '{sign}({W}+)', 1), [])"


def words(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda w: w <> '')"


def joined(array: str) -> str:
    return f"coalesce(array_to_string({array}, ' '), '')"


def integer(c: str) -> str:
    return f"CASE WHEN {c} <> 'N/A' THEN CAST({c} AS INT) END"


def number(c: str) -> str:
    return f"CAST(coalesce({integer(c)}, 0) AS DOUBLE)"


def query(body: str, *ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join([POSTS, *ctes]) + "\n" + body


def per_post(expression: str, *ctes: str) -> str:
    return query(f"SELECT post_id, {expression} AS value FROM posts", *ctes)


def top(source: str, by: str, tie: str, k: int) -> str:
    return f"SELECT * FROM ({source}) ORDER BY {by} DESC NULLS LAST, {tie} LIMIT {k}"


def topic_passes(topics: int = 5, passes: int = 15) -> list[str]:
    """Expectation-maximisation from the stated start, pass by pass."""
    each = range(topics)

    def listed(form: str) -> str:
        return ", ".join(form.format(k=k) for k in each)

    total = " + ".join(f"t{k} * p{k}" for k in each)
    start = "(CAST('0x' || substr(md5(word || ':{k}'), 1, 8) AS BIGINT) / 4294967296.0 + 0.01)"
    ctes = [
        f"cells AS MATERIALIZED (SELECT post_id, word, count(*) AS n FROM (SELECT post_id,"
        f" unnest({words('clean_text')}) AS word FROM cleaned) GROUP BY 1, 2)",
        f"begun AS MATERIALIZED (SELECT word, {listed(start + ' AS p{k}')} FROM (SELECT DISTINCT word FROM cells))",
        f"w0 AS MATERIALIZED (SELECT word, {listed('p{k} / (SELECT sum(p{k}) FROM begun) AS p{k}')} FROM begun)",
        f"m0 AS (SELECT DISTINCT post_id, {listed(f'CAST({1 / topics} AS DOUBLE) AS t{{k}}')} FROM cells)",
    ]
    for i in range(passes):
        weighed = (
            f"(SELECT post_id, word, n, {listed('n * t{k} * p{k} / z AS c{k}')} FROM"
            f" (SELECT *, {total} AS z FROM cells JOIN {{m}} USING (post_id) JOIN w{i} USING (word)))"
        )
        ctes += [
            f"m{i + 1} AS MATERIALIZED (SELECT post_id,"
            f" {listed(f'(sum(c{{k}}) + 0.1) / (sum(n) + {topics} * 0.1) AS t{{k}}')}"
            f" FROM {weighed.format(m=f'm{i}')} GROUP BY post_id)",
            f"s{i + 1} AS MATERIALIZED (SELECT word, {listed('sum(c{k}) AS p{k}')}"
            f" FROM {weighed.format(m=f'm{i}')} GROUP BY word)",
            f"w{i + 1} AS MATERIALIZED (SELECT word, "
            + listed(f"(p{{k}} + 0.01) / (SELECT sum(p{{k}}) + count(*) * 0.01 FROM s{i + 1}) AS p{{k}}")
            + f" FROM s{i + 1})",
        ]
    unpivoted = " UNION ALL ".join(
        f"SELECT {k} AS topic, word, round(p{k}, 9) AS weight FROM w{passes}" for k in each
    )
    shares = "[" + listed("round(t{k}, 6)") + "]"
    return [
        *ctes,
        "keywords AS (SELECT topic, word, weight, row_number() OVER (PARTITION BY topic"
        f" ORDER BY weight DESC, word) AS rank FROM ({unpivoted}) QUALIFY rank <= 10)",
        f"dominant AS (SELECT post_id, list_position(s, list_max(s)) - 1 AS topic FROM"
        f" (SELECT post_id, {shares} AS s FROM m{passes}))",
    ]


def oracle() -> dict[str, str]:
    stop = _strings(schema.stopwords())
    cleaned = f"cleaned AS (SELECT *, {clean('text')} AS clean_text FROM posts)"
    tags = f"tags AS (SELECT post_id, ts, unnest({names_after('text', '#')}) AS hashtag FROM posts)"
    tag_counts = "SELECT hashtag, count(*) AS n FROM tags GROUP BY hashtag"
    place_rows = ", ".join(f"('{t}', '{p}', {lat}, {lon})" for t, p, lat, lon in schema.PLACES)
    places = (
        "places AS (SELECT tag, place, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon"
        f" FROM (VALUES {place_rows}) v(tag, place, lat, lon))"
    )

    # Sentiment: words with the word before, joined with the lexicon.
    lexicon_rows = ", ".join(f"('{w}', {p})" for w, p in schema.LEXICON)
    lexicon = (
        "lexicon AS (SELECT word, CAST(polarity AS DOUBLE) AS polarity"
        f" FROM (VALUES {lexicon_rows}) v(word, polarity))"
    )
    positions = (
        "positions AS (SELECT post_id, w, unnest(generate_series(1, len(w))) AS i"
        f" FROM (SELECT post_id, {words('clean_text')} AS w FROM cleaned))"
    )
    hits = (
        "hits AS (SELECT post_id, avg(polarity * CASE WHEN i > 1 AND w[i - 1] IN"
        f" ({_strings(schema.NEGATORS)}) THEN -0.5 ELSE 1.0 END) AS score"
        " FROM positions JOIN lexicon ON lexicon.word = w[i] GROUP BY post_id)"
    )
    scored = (
        "scored AS (SELECT p.*, s.score, CASE WHEN s.score > 0.1 THEN 'Positive'"
        " WHEN s.score < -0.1 THEN 'Negative' ELSE 'Neutral' END AS sentiment FROM posts p"
        " JOIN (SELECT q.post_id, coalesce(h.score, 0.0) AS score FROM posts q"
        " LEFT JOIN hits h ON h.post_id = q.post_id) s ON s.post_id = p.post_id)"
    )
    sentiment = (cleaned, lexicon, positions, hits, scored)

    # First hashtag of each post that names a place.
    placed = f"""
placed AS (
  SELECT p.post_id, f.hashtag AS location_hashtag, f.place AS location_name,
    f.lat AS latitude, f.lon AS longitude
  FROM posts p LEFT JOIN (
    SELECT post_id, hashtag, place, lat, lon FROM (
      SELECT t.post_id, t.h[t.i] AS hashtag, l.place, l.lat, l.lon,
        row_number() OVER (PARTITION BY t.post_id ORDER BY t.i) AS nth
      FROM (SELECT post_id, h, unnest(generate_series(1, len(h))) AS i
            FROM (SELECT post_id, {names_after('text', '#')} AS h FROM posts)) t
      JOIN places l ON l.tag = '#' || t.h[t.i])
    WHERE nth = 1) f ON f.post_id = p.post_id
)"""

    metric_columns = ", ".join(f"{integer(m)} AS {m}" for m in schema.METRICS)
    number_columns = ", ".join(f"{number(m)} AS {m}" for m in schema.CHART_METRICS)
    user_sums = ", ".join(f"sum({number(m)}) AS {m}" for m in schema.CHART_METRICS)
    author_sums = ", ".join(
        f"CAST(sum({integer(m)}) AS BIGINT) AS total_{m}" for m in schema.METRICS
    )
    author_total = " + ".join(f"total_{m}" for m in schema.METRICS)
    authors = (
        f"SELECT *, {author_total} AS total_engagement FROM"
        f" (SELECT author_id, {author_sums} FROM posts GROUP BY author_id)"
    )
    post_total = " + ".join(f"CAST({integer(m)} AS BIGINT)" for m in schema.METRICS)
    engaged = " OR ".join(f"({integer(m)}) > 0" for m in ("retweets", "replies", "likes"))
    chart_total = " + ".join(number(m) for m in schema.CHART_METRICS)
    content_type = (
        "CASE WHEN text IS NULL THEN 'Other'"
        " WHEN contains(text, 'http') OR contains(text, 'www') THEN 'Links'"
        " WHEN contains(text, '#') THEN 'Hashtags' WHEN contains(text, '@') THEN 'Mentions'"
        " WHEN length(text) > 140 THEN 'Long Text' ELSE 'Short Text' END"
    )
    city = (
        "SELECT l.place AS city, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS t"
        f" FROM posts) JOIN places l ON l.tag = {replace('t', f'^[{WS}]+|[{WS}]+$')} GROUP BY 1"
    )
    key_metrics = f"""
SELECT count(*) AS total_posts, count(DISTINCT username) AS unique_users,
  CAST(sum({chart_total}) AS BIGINT) AS total_engagement,
  CAST(floor(CAST(count(*) FILTER (sentiment = 'Positive') AS DOUBLE) / count(*) * 100)
    AS BIGINT) AS positive_percent
FROM scored"""
    overlapping = f"both_tables AS (SELECT * FROM posts UNION ALL SELECT * FROM posts WHERE {engaged})"
    terms = f"terms AS (SELECT post_id, unnest(regexp_extract_all(clean_text, '({W}{{2,}})', 1)) AS term FROM cleaned)"
    best_terms = top(
        f"SELECT term, count(*) AS n FROM terms WHERE term NOT IN ({stop})"
        " GROUP BY term HAVING count(DISTINCT post_id) >= 2",
        "n",
        "term",
        50,
    )

    # Graphs.
    value_edges = f"""
value_edges AS (
  SELECT DISTINCT least(author_id, v) AS src, greatest(author_id, v) AS dst FROM (
    {' UNION ALL '.join(
        f'SELECT author_id, CAST({integer(m)} AS BIGINT) AS v FROM posts'
        for m in ('retweets', 'replies', 'likes'))})
  WHERE v > 0 AND author_id IS NOT NULL
)"""

    def degree(edges: str) -> str:
        return (
            f"SELECT id, count(*) AS degree FROM (SELECT src AS id FROM {edges}"
            f" UNION ALL SELECT dst FROM {edges}) GROUP BY id"
        )

    centrality = (
        f"centrality AS (SELECT id, degree, round(CAST(degree AS DOUBLE) /"
        f" (SELECT count(*) - 1 FROM ({degree('value_edges')})), 9) AS centrality"
        f" FROM ({degree('value_edges')}))"
    )
    influencers = top("SELECT * FROM centrality", "centrality", "id", 10)

    def links(source: str = "posts", where: str = "true") -> str:
        return f"""
links AS (
  SELECT post_id, least(username, target) AS src, greatest(username, target) AS dst, kind
  FROM (
    SELECT post_id, username, unnest({names_after('text', '@')}) AS target, 'mention' AS kind
    FROM {source} WHERE {where}
    UNION ALL
    SELECT post_id, username, regexp_extract(text, 'RT @({W}+)', 1), 'retweet'
    FROM {source} WHERE {where} AND starts_with(text, 'RT @'))
  WHERE username IS NOT NULL AND username <> '' AND target <> '' AND target <> username
)"""

    edges = """
edges AS (
  SELECT src, dst, count(*) AS weight, count(DISTINCT post_id) AS n_posts,
    string_agg(DISTINCT kind, ', ' ORDER BY kind) AS types
  FROM links GROUP BY src, dst
)"""
    titled = "SELECT *, types || ' (' || CAST(weight AS VARCHAR) || ' times)' AS title FROM "
    kept = f"kept AS (SELECT id FROM ({degree('edges')}) WHERE degree >= 2)"
    pruned = (
        "pruned AS (SELECT * FROM edges WHERE src IN (SELECT id FROM kept)"
        " AND dst IN (SELECT id FROM kept))"
    )
    nodes = f"""
SELECT id, degree, centrality, round(5.0 + 20.0 * centrality, 6) AS size,
  'User: ' || id AS title
FROM (
  SELECT k.id, coalesce(d.degree, 0) AS degree,
    round(CAST(coalesce(d.degree, 0) AS DOUBLE) / (SELECT count(*) - 1 FROM kept), 9) AS centrality
  FROM kept k LEFT JOIN ({degree('pruned')}) d ON d.id = k.id)"""
    both_ways = """
arcs AS (
  SELECT src AS a, dst AS b, weight FROM edges UNION ALL SELECT dst, src, weight FROM edges
)"""
    reach = "reach(id, root) AS (SELECT a, a FROM arcs UNION SELECT r.id, arcs.b FROM reach r JOIN arcs ON arcs.a = r.root)"
    communities = f"""
SELECT label AS community, count(*) AS size, CAST(coalesce(sum(posts), 0) AS BIGINT) AS posts,
  round(coalesce(sum(total) / nullif(sum(posts), 0), 0.0), 6) AS avg_engagement
FROM settled LEFT JOIN (
  SELECT username, count(*) AS posts, sum({chart_total}) AS total FROM posts
  WHERE username IS NOT NULL GROUP BY username) u ON u.username = settled.id
GROUP BY label"""

    # Until the labels repeat: they stay, or two states take turns; then the smaller of the two.
    rounds_on = """
state(n, id, label, last, older) AS (
  SELECT DISTINCT 0, a, a, a, a FROM arcs
  UNION ALL
  SELECT n + 1, s.id, chosen.label, s.label, s.last
  FROM state s JOIN (
    SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY votes DESC, label) AS nth
    FROM (SELECT arcs.b AS id, l.label, sum(weight) AS votes
          FROM arcs JOIN state l ON l.id = arcs.a GROUP BY 1, 2)
  ) chosen ON chosen.id = s.id AND nth = 1
  WHERE n = 0 OR EXISTS (SELECT 1 FROM state WHERE label <> last)
    AND (n = 1 OR EXISTS (SELECT 1 FROM state WHERE label <> older))
)"""
    last_round = """
settled AS (
  SELECT id, least(label, last) AS label FROM state WHERE n = (SELECT max(n) FROM state)
)"""
    settled = (links(), edges, both_ways, rounds_on, last_round)

    day = "strftime(ts, '%Y-%m-%d')"
    best_tags = top(tag_counts, "n", "hashtag", 5)
    trends = f"""
SELECT strftime(c.day, '%Y-%m-%d') AS day, c.hashtag, coalesce(x.n, 0) AS n
FROM (SELECT hashtag, unnest(generate_series((SELECT min(CAST(ts AS DATE)) FROM posts),
        (SELECT max(CAST(ts AS DATE)) FROM posts), INTERVAL 1 DAY)) AS day
      FROM ({best_tags})) c
LEFT JOIN (SELECT CAST(ts AS DATE) AS day, hashtag, count(*) AS n FROM tags GROUP BY 1, 2) x
  ON x.day = c.day AND x.hashtag = c.hashtag"""
    lemma_cases = {"ands": "and", "hes": "he", "ing": "ings", "great": "greatness", **dict(schema.LEMMAS)}

    def lemma(c: str, lemmas: dict[str, str]) -> str:
        cases = " ".join(f"WHEN '{form}' THEN '{lemma}'" for form, lemma in lemmas.items())
        return f"list_transform({c}, lambda w: CASE w {cases} ELSE w END)"

    alphabetic = (
        rf"list_filter({words('clean_text')}, lambda w: regexp_matches(w, '^\p{{L}}+$')"
        f" AND w NOT IN ({stop}))"
    )
    # Dictionaries learned from the feed.
    worded = f"worded AS (SELECT post_id, {words('clean_text')} AS w FROM cleaned)"
    seeds = "seeds(word, polarity) AS (VALUES " + ", ".join(
        f"('{word}', CAST({value} AS DOUBLE))" for word, value in schema.LEXICON
    ) + ")"
    learned = (
        cleaned, worded, seeds,
        "placed_words AS (SELECT post_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i, w"
        " FROM worded)",
        "opened AS (SELECT p.post_id, p.i, w, CASE WHEN p.i > 1 AND w[p.i - 1] IN"
        f" ({_strings(schema.NEGATORS)}) THEN -sign(polarity) ELSE sign(polarity) END AS side"
        " FROM placed_words p JOIN seeds USING (word))",
        "near AS (SELECT side, w[i + d] AS word FROM opened, (VALUES (-5), (-4), (-3), (-2), (-1),"
        " (1), (2), (3), (4), (5)) t(d) WHERE i + d BETWEEN 1 AND len(w))",
        "sides AS (SELECT word, CAST(count(*) FILTER (side > 0) AS DOUBLE) AS good,"
        " CAST(count(*) FILTER (side < 0) AS DOUBLE) AS ill FROM near GROUP BY word)",
        "chances AS (SELECT word, good + ill AS support,"
        " (good + 0.5::DOUBLE) * ((SELECT sum(ill) FROM sides) + 1) AS p,"
        " (ill + 0.5::DOUBLE) * ((SELECT sum(good) FROM sides) + 1) AS q FROM sides)",
        "learned AS (SELECT word, (p - q) / (p + q) AS polarity, CAST(support AS BIGINT) AS support"
        f" FROM chances WHERE support >= 10 AND word NOT IN ({stop})"
        r" AND regexp_matches(word, '^\p{L}+$') AND word NOT IN (SELECT word FROM seeds)"
        " UNION ALL SELECT word, polarity, NULL FROM seeds)",
    )
    learned_scores = (
        "hits AS (SELECT post_id, avg(l.polarity * CASE WHEN i > 1 AND w[i - 1] IN"
        f" ({_strings(schema.NEGATORS)}) THEN -0.5 ELSE 1.0 END) AS score"
        " FROM placed_words JOIN learned l USING (word) GROUP BY post_id)"
    )
    endings = ", ".join(
        f"({i}, '{ending}', '{put}')" for i, (ending, put) in enumerate(schema.NOUN_ENDINGS)
    )
    irregular = ", ".join(f"('{form}', '{lemma}')" for form, lemma in schema.LEMMA_EXCEPTIONS)
    ruled = (
        cleaned,
        f"spoken AS (SELECT post_id, {alphabetic} AS w FROM cleaned)",
        "vocabulary AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM spoken)"
        " GROUP BY word)",
        f"endings(rank, ending, put) AS (VALUES {endings})",
        f"irregular(form, lemma) AS (VALUES {irregular})",
        "candidates AS (SELECT word AS form, n, rank,"
        " left(word, length(word) - length(ending)) || put AS lemma FROM vocabulary JOIN endings"
        " ON ends_with(word, ending) AND length(word) - length(ending) >= 2"
        " AND NOT (ending = 's' AND ends_with(word, 'ss')))",
        "ruled AS (SELECT form, arg_min(lemma, rank) AS lemma, any_value(n) AS n FROM candidates"
        " WHERE lemma IN (SELECT word FROM vocabulary)"
        " AND form NOT IN (SELECT form FROM irregular) GROUP BY form"
        " UNION ALL SELECT form, lemma, n FROM vocabulary JOIN irregular ON word = form)",
    )
    user_columns = ", ".join(
        f"coalesce(CAST(u.{c} AS VARCHAR), 'N/A') AS {c}"
        for c in ("username", "followers", "following", "total_posts")
    )
    payload_metrics = ", ".join(
        f"CAST({integer('p.' + m)} AS VARCHAR) AS {m}" for m in schema.METRICS
    )
    search = _strings(schema.SEARCH_HASHTAGS)
    seconds = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
    # Dictionaries of all words of the documents, and a feed that holds posts twice.
    known = (
        f"known AS (SELECT DISTINCT unnest({words(clean('text'))}) AS word FROM documents)"
    )
    feed = f"feed AS (SELECT * FROM posts UNION ALL SELECT * FROM posts WHERE {engaged})"
    large_hits = (
        "hits AS (SELECT post_id, avg(((length(word) * 7) % 21 - 10) / 10.0 * CASE WHEN i > 1"
        f" AND w[i - 1] IN ({_strings(schema.NEGATORS)}) THEN -0.5 ELSE 1.0 END) AS score"
        " FROM positions JOIN known ON known.word = w[i] GROUP BY post_id)"
    )
    large_places = (
        places.replace("places AS", "few AS", 1)
        + ", places AS (SELECT * FROM few UNION ALL SELECT '#' || word, 'at ' || word,"
        " CAST(length(word) AS DOUBLE), CAST(-length(word) AS DOUBLE) FROM known"
        " UNION ALL SELECT '#AI', 'Lab', 1.0, 2.0)"
    )

    found = {
        "csv_roundtrip": query(
            f"SELECT post_id, text, {seconds} AS ts, author_id, username, likes, retweets, replies,"
            " quotes, lang FROM posts"
        ),
        "flatten_payload": query(
            f"SELECT p.post_id, p.text, {seconds} AS ts, p.author_id, p.lang, {payload_metrics},"
            f" {user_columns}"
            " FROM posts p LEFT JOIN users u ON u.id = p.author_id",
            USERS,
        ),
        "location_dim": query(
            "SELECT tag, place, lat, lon, coalesce(n, 0) AS n FROM places"
            f" LEFT JOIN ({tag_counts}) t ON '#' || t.hashtag = tag",
            tags,
            places,
        ),
        "posts_to_lines": query(
            "SELECT " + replace("text", r"\r\n|[\r\n]", " ") + " AS value FROM posts WHERE text IS NOT NULL"
        ),
        "top_posts": query(
            top(f"SELECT post_id, text, {post_total} AS total_engagement FROM posts",
                "total_engagement", "post_id", 10)
        ),
        "metrics_cast": query(f"SELECT post_id, {metric_columns} FROM posts"),
        "metrics_coerced": query(f"SELECT post_id, {number_columns} FROM posts"),
        "engaged_posts": query(f"SELECT post_id, username FROM posts WHERE {engaged}"),
        "search_posts": query(
            "SELECT post_id, author_id, text FROM posts WHERE lang = 'en'"
            " AND NOT starts_with(text, 'RT @') AND list_has_any(list_transform("
            f"{names_after('text', '#')}, lambda h: lower(h)), [{search}])"
        ),
        "clean_text_ascii": per_post(clean("text", True)),
        "clean_text_unicode": per_post(clean("text")),
        "remove_stopwords": per_post(
            joined(f"list_filter({words(clean('text', True))}, lambda w: w NOT IN ({stop}))")
        ),
        "extract_hashtags": per_post(joined(names_after("text", "#"))),
        "extract_mentions": per_post(joined(names_after("text", "@"))),
        "whitespace_tokens": per_post(
            joined(f"list_filter(regexp_split_to_array(lower(text), '[{WS}]+'), lambda w: w <> '')")
        ),
        "content_types": per_post(content_type),
        "tokens": query(
            f"SELECT post_id, {joined(lemma(alphabetic, dict(schema.LEMMAS)))} AS value FROM cleaned",
            cleaned,
        ),
        "lemmatize": query(
            f"SELECT post_id, {joined(lemma(words('clean_text'), lemma_cases))} AS value FROM cleaned",
            cleaned,
        ),
        "time_features": query(
            f"SELECT post_id, {day} AS day, CAST(hour(ts) AS INT) AS hour,"
            " CAST(dayofweek(ts) + 1 AS INT) AS day_of_week FROM posts"
        ),
        "sentiment_score": query(
            "SELECT post_id, round(score, 9) AS score FROM scored", *sentiment
        ),
        "sentiment_large_lexicon": query(
            "SELECT f.post_id, round(coalesce(score, 0), 9) AS score FROM feed f"
            " LEFT JOIN hits USING (post_id)",
            cleaned, known, feed, positions, large_hits,
        ),
        "lexicon_learned": query("SELECT * FROM learned", *learned),
        "sentiment_learned": query(
            "SELECT CASE WHEN coalesce(score, 0) > 0.1 THEN 'Positive'"
            " WHEN coalesce(score, 0) < -0.1 THEN 'Negative' ELSE 'Neutral' END AS sentiment,"
            " count(*) AS n FROM posts LEFT JOIN hits USING (post_id) GROUP BY 1",
            *learned, learned_scores,
        ),
        "lemma_rules": query("SELECT * FROM ruled", *ruled),
        "lemmatize_rules": query(
            "SELECT post_id, coalesce(value, '') AS value FROM posts LEFT JOIN (SELECT post_id,"
            " string_agg(coalesce(lemma, word), ' ' ORDER BY i) AS value FROM (SELECT post_id,"
            " unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM spoken)"
            " LEFT JOIN ruled ON form = word GROUP BY post_id) USING (post_id)",
            *ruled,
        ),
        "lemmatize_large": query(
            f"SELECT post_id, {joined('list_transform(w, lambda x: x || chr(115))')} AS value FROM"
            f" (SELECT post_id, {words('clean_text')} AS w FROM (SELECT *, {clean('text')}"
            " AS clean_text FROM feed))",
            feed,
        ),
        "post_location_large": query(
            "SELECT p.* FROM feed f JOIN placed p ON p.post_id = f.post_id",
            known, feed, large_places, placed,
        ),
        "sentiment_labels": query("SELECT post_id, sentiment FROM scored", *sentiment),
        "sentiment_distribution": query(
            "SELECT sentiment, count(*) AS n FROM scored GROUP BY sentiment", *sentiment
        ),
        "sentiment_trends": query(
            "SELECT day, sentiment, n, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY day)"
            f" * 100, 6) AS percentage FROM (SELECT {day} AS day, sentiment, count(*) AS n"
            " FROM scored GROUP BY 1, 2)",
            *sentiment,
        ),
        "score_text": query(
            "SELECT post_id, CAST(coalesce(length(text) - length(replace(text, '!', '')), 0)"
            " AS DOUBLE) AS score FROM posts"
        ),
        "key_metrics": query(key_metrics, *sentiment),
        "key_metrics_text": query(
            "SELECT format('{:,}', total_posts) AS total_posts,"
            " format('{:,}', unique_users) AS unique_users,"
            " format('{:,}', total_engagement) AS total_engagement,"
            f" CAST(positive_percent AS VARCHAR) || '%' AS positive_percent FROM ({key_metrics})",
            *sentiment,
        ),
        "author_engagement": query(authors),
        "top_authors": query(top(authors, "total_engagement", "author_id", 10)),
        "engagement_totals": query(
            " UNION ALL ".join(
                f"SELECT '{m}' AS metric, CAST(sum({number(m)}) AS BIGINT) AS total FROM posts"
                for m in schema.CHART_METRICS
            )
        ),
        "user_engagement_top15": query(
            "SELECT * FROM (" + top(
                "SELECT *, likes + retweets + replies AS total_engagement FROM (SELECT username,"
                f" {user_sums} FROM posts WHERE username IS NOT NULL GROUP BY username)",
                "total_engagement", "username", 15,
            ) + ") WHERE trim(username) <> '0'"
        ),
        "most_active_users": query(
            top("SELECT username, count(*) AS posts FROM posts WHERE username IS NOT NULL"
                " GROUP BY username", "posts", "username", 10)
        ),
        "distinct_users": query("SELECT DISTINCT username FROM posts WHERE username IS NOT NULL"),
        "content_engagement": query(
            f"SELECT {content_type} AS content_type, "
            + ", ".join(f"round(avg({number(m)}), 6) AS avg_{m}" for m in schema.CHART_METRICS)
            + " FROM posts GROUP BY 1"
        ),
        "posts_with_users": query(
            f"SELECT p.post_id, p.author_id, {user_columns} FROM posts p"
            " LEFT JOIN users u ON u.id = p.author_id",
            USERS,
        ),
        "top_hashtags": query(top(tag_counts, "n", "hashtag", 10), tags),
        "token_array_counts": query(
            "SELECT array_to_string(t, ' ') AS tokens, n FROM"
            " (SELECT string_split(text, ' ') AS t, count(*) AS n FROM posts GROUP BY 1)"
        ),
        "word_frequencies": query(
            top("SELECT word, count(*) AS n FROM (SELECT unnest(" + words("clean_text") + ") AS word"
                f" FROM cleaned) WHERE length(word) >= 2 AND word NOT IN ({stop}) GROUP BY word",
                "n", "word", 200),
            cleaned,
        ),
        "term_counts": query(top(best_terms, "n", "term", 15), cleaned, terms),
        "bag_of_words": query(
            "SELECT post_id, term, count(*) AS n FROM (SELECT post_id, unnest("
            + words("clean_text") + ") AS term FROM cleaned) GROUP BY post_id, term",
            cleaned,
        ),
        "hashtag_trends": query(trends, tags),
        "user_growth": query(
            "SELECT day, new_users, CAST(sum(new_users) OVER (ORDER BY day) AS BIGINT)"
            " AS cumulative_users FROM (SELECT day, count(*) AS new_users FROM (SELECT username,"
            f" min({day}) AS day FROM posts WHERE username IS NOT NULL GROUP BY username)"
            " GROUP BY day)"
        ),
        "unique_users_by_span": query(
            "SELECT strftime(d.day, '%Y-%m-%d') AS day, count(DISTINCT username) AS users, TRUE AS within"
            " FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM posts WHERE ts IS NOT NULL AND username"
            " IS NOT NULL) d JOIN posts p ON CAST(p.ts AS DATE) BETWEEN d.day - 6 AND d.day"
            " WHERE username IS NOT NULL GROUP BY d.day"
        ),
        "posts_by_hour": query(
            "SELECT CAST(hour(ts) AS INT) AS hour, count(*) AS n FROM posts GROUP BY 1"
        ),
        "posts_by_weekday": query(
            "SELECT CAST(dayofweek(ts) + 1 AS INT) AS day_of_week, count(*) AS n FROM posts GROUP BY 1"
        ),
        "merge_dedup": query(
            "SELECT post_id, author_id, text FROM (SELECT DISTINCT * FROM both_tables)", overlapping
        ),
        "dedup_stats": query(
            "SELECT t AS total_rows, t - d AS duplicate_rows, d AS distinct_rows FROM"
            " (SELECT (SELECT count(*) FROM both_tables) AS t,"
            " (SELECT count(*) FROM (SELECT DISTINCT * FROM both_tables)) AS d)",
            overlapping,
        ),
        "city_mentions": query(city, places),
        "city_top20": query(top(city, "n", "city", 20), places),
        "post_location": query("SELECT * FROM placed", places, placed),
        "location_counts": query(
            top("SELECT location_name, count(*) AS n FROM placed WHERE location_name IS NOT NULL"
                " GROUP BY location_name", "n", "location_name", 10),
            places, placed,
        ),
        "geo_sentiment": query(
            "SELECT location_name, sentiment, n, round(CAST(n AS DOUBLE) / sum(n) OVER"
            " (PARTITION BY location_name) * 100, 6) AS percentage FROM (SELECT location_name,"
            " sentiment, count(*) AS n FROM placed JOIN scored ON scored.post_id = placed.post_id"
            " WHERE location_name IS NOT NULL GROUP BY 1, 2) WHERE location_name IN ("
            "SELECT location_name FROM placed WHERE location_name IS NOT NULL"
            " GROUP BY location_name ORDER BY count(*) DESC, location_name LIMIT 10)",
            places, placed, *sentiment,
        ),
        "location_markers": query(
            top("SELECT *, location_name || ': ' || CAST(n AS VARCHAR) || ' posts, top hashtag '"
                " || top_hashtag AS popup FROM (SELECT location_name, CAST(sum(c) AS BIGINT) AS n,"
                " arg_min(location_hashtag, (-c, location_hashtag)) AS top_hashtag,"
                " min(lat) AS latitude, min(lon) AS longitude FROM (SELECT location_name,"
                " location_hashtag, count(*) AS c, min(latitude) AS lat, min(longitude) AS lon"
                " FROM placed WHERE location_name IS NOT NULL GROUP BY 1, 2) GROUP BY 1)",
                "n", "location_name", 10),
            places, placed,
        ),
        "geo_center": query(
            "SELECT round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude"
            " FROM placed",
            places, placed,
        ),
        "geo_density": query(
            "SELECT CAST(floor(latitude / 10.0) AS BIGINT) AS lat_cell,"
            " CAST(floor(longitude / 10.0) AS BIGINT) AS lon_cell, count(*) AS n FROM placed"
            " WHERE latitude IS NOT NULL GROUP BY 1, 2",
            places, placed,
        ),
        "engagement_value_edges": query("SELECT * FROM value_edges", value_edges),
        "degree_centrality": query("SELECT * FROM centrality", value_edges, centrality),
        "top_influencers": query(influencers, value_edges, centrality),
        "influencer_flags": query(
            f"SELECT *, id IN (SELECT id FROM ({influencers})) AS is_top FROM centrality",
            value_edges, centrality,
        ),
        "interaction_edges": query(titled + "edges", links(), edges),
        "interaction_edges_positive": query(
            titled + "edges", *sentiment, links("scored", "sentiment = 'Positive'"), edges
        ),
        "interaction_edges_negative": query(
            titled + "edges", *sentiment, links("scored", "sentiment = 'Negative'"), edges
        ),
        "edge_posts": query("SELECT DISTINCT src, dst, post_id FROM links", links()),
        "interaction_edges_pruned": query(titled + "pruned", links(), edges, kept, pruned),
        "interaction_nodes": query(nodes, links(), edges, kept, pruned),
        "graph_stats": query(
            f"SELECT (SELECT count(*) FROM ({degree('edges')})) AS vertices, count(*) AS edges"
            " FROM edges",
            links(), edges,
        ),
        "top_mentioned": query(
            top("SELECT username, count(*) AS mentions FROM (SELECT unnest("
                + names_after("text", "@") + ") AS username FROM posts) GROUP BY username",
                "mentions", "username", 10)
        ),
        "connected_components": query(
            "SELECT id, min(root) AS component FROM reach GROUP BY id",
            links(), edges, both_ways, reach,
        ),
        "communities": query("SELECT id, label AS community FROM settled", *settled),
        "community_summary": query(communities, *settled),
        "communities_settled": query("SELECT id, label AS community FROM settled", *settled),
        "community_summary_settled": query(communities, *settled),
        "communities_numbered": query(
            "SELECT id, CAST(dense_rank() OVER (ORDER BY label) AS INTEGER) AS community FROM settled",
            *settled,
        ),
        "topic_keywords": query(
            "SELECT topic, CAST(rank AS INTEGER) AS rank, word, weight FROM keywords", cleaned, *topic_passes()
        ),
        "topic_model": query(
            "SELECT topic, string_agg(word, ', ' ORDER BY rank) AS words FROM keywords GROUP BY topic",
            cleaned, *topic_passes(),
        ),
        "topic_distribution": query(
            "SELECT topic, count(*) AS n FROM dominant JOIN posts USING (post_id) GROUP BY topic",
            cleaned, *topic_passes(),
        ),
        "topic_evolution": query(
            f"SELECT day, topic, n, round(n / sum(n) OVER (PARTITION BY day) * 100, 6) AS percentage"
            f" FROM (SELECT {day} AS day, topic, count(*) AS n FROM dominant JOIN posts USING (post_id)"
            " WHERE ts IS NOT NULL GROUP BY 1, 2)",
            cleaned, *topic_passes(),
        ),
        "topic_terms": query(
            f"SELECT {day} AS day, count(*) AS posts, CAST(sum(len({words('clean_text')})) AS BIGINT)"
            " AS words FROM cleaned WHERE clean_text <> '' GROUP BY 1",
            cleaned,
        ),
        "topic_coverage": query(
            f"SELECT {day} AS day, count(*) AS posts, TRUE AS whole FROM cleaned"
            " WHERE clean_text <> '' AND ts IS NOT NULL GROUP BY 1",
            cleaned,
        ),
        "stream_hashtags": query(
            "SELECT hashtag, count(*) AS n FROM (SELECT unnest(list_filter(regexp_split_to_array("
            f"lower(text), '[{WS}]+'), lambda w: starts_with(w, '#'))) AS hashtag FROM posts)"
            " GROUP BY hashtag"
        ),
        "stream_trending": query(
            f"SELECT {day} AS day, hashtag, count(*) AS n FROM tags GROUP BY 1, 2",
            tags,
        ),
    }
    # All charts of the roll-up, each by its own query.
    def chart(name: str, day: str = "NULL", item: str = "NULL", part: str = "NULL", n: str = "n", value: str = "NULL") -> str:
        columns = f"CAST({day} AS VARCHAR), CAST({item} AS VARCHAR), CAST({part} AS VARCHAR)"
        return f"SELECT '{name}', {columns}, CAST({n} AS BIGINT), CAST({value} AS DOUBLE) FROM ({found[name]})"

    shown = [
        chart("top_hashtags", item="hashtag"),
        chart("sentiment_distribution", item="sentiment"),
        chart("sentiment_trends", day="day", item="sentiment", value="percentage"),
        chart("location_counts", item="location_name"),
        chart("geo_sentiment", item="location_name", part="sentiment", value="percentage"),
        chart("most_active_users", item="username", n="posts"),
        chart("user_growth", day="day", n="new_users", value="cumulative_users"),
        *[
            f"SELECT 'key_metrics', NULL, '{m}', NULL, CAST({m} AS BIGINT), NULL FROM ({found['key_metrics']})"
            for m in ("total_posts", "unique_users", "total_engagement", "positive_percent")
        ],
    ]
    for name in ("chart_rollup", "chart_refresh"):
        found[name] = (
            "SELECT * FROM (" + " UNION ALL ".join(f"({x})" for x in shown)
            + ") AS charts(chart, day, item, part, n, value)"
        )
    found["stream_hashtags_recovered"] = found["stream_hashtags"]
    found["word_frequencies_heavy"] = found["word_frequencies"]
    found["search_posts_indexed"] = found["search_posts"]
    # The same reports, read from the enriched table.
    for name in ("key_metrics", "sentiment_trends", "geo_sentiment"):
        found[f"enriched_{name}"] = found[name]
    return found
