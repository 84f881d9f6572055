"""The registered queries as DuckDB SQL over the same tables.

Each text is put together from the common table expressions below, which
follow the definitions of the test posts, and not from the Spark programs:
the expected fault of a raw message, say, follows from its number ``k`` and
no JSON is parsed.
"""

from __future__ import annotations

_BLANK_TITLE = "(' ' || chr(9) || ' ')"
_BLANK_LINE = "(' ' || chr(9))"

# Fixed values within: the patterns that clean titles, the limits of the engagement
# classes (50 votes with 10 answers, 20, 0) and the seven rows of the rolling sum.
_CTES = {
    "numbered": """
SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       epoch_us(ts) // 1000000 AS seconds
FROM events""",
    "captures": """
SELECT event_id AS seq,
       CAST(epoch_us(ts) // 86400000000 AS BIGINT) AS batch_id,
       'm' || event_id AS message_id,
       ts AS publish_ts,
       k,
       event_type,
       user_id AS user_number,
       CASE WHEN k >= 90 AND event_id >= k - 89 THEN event_id - (k - 89)
            ELSE event_id END AS question_id,
       event_type || ' «' || props || '» déjà-vu nº ' || event_id AS own_title,
       CASE WHEN k <> 23 THEN CAST(floor(value) AS INTEGER) - 20 END AS score,
       CASE WHEN k <> 17 THEN CAST(user_id % 15 AS INTEGER) END AS answer_count,
       CAST(floor(value * 10) AS INTEGER) AS view_count,
       event_type = 'purchase' AS is_answered,
       CASE WHEN k <> 53 THEN CAST(seconds AS BIGINT) END AS creation_date,
       CAST(seconds AS BIGINT) + CAST(floor(value * 1000) AS BIGINT)
           AS last_activity_date,
       [event_type, 'k' || k] AS tags,
       CASE WHEN k <> 31 THEN 'CC BY-SA 4.0' END AS content_license,
       k <> 29 AS has_owner
FROM numbered""",
    "linked": """
SELECT *,
       'https://example.org/q/' || question_id AS link,
       CASE WHEN has_owner THEN user_number + 1000000 END AS owner_account_id,
       CASE WHEN has_owner THEN user_number END AS owner_user_id,
       CASE WHEN has_owner THEN CAST(user_number % 1000 AS INTEGER) END
           AS owner_reputation,
       CASE WHEN has_owner THEN 'registered' END AS owner_user_type,
       CASE WHEN has_owner AND k <> 71 THEN 'User#' || user_number END
           AS owner_display_name
FROM captures""",
    "posts": """
SELECT l.*,
       CASE WHEN k = 37 THEN NULL
            WHEN k = 41 THEN {blank_title}
            ELSE coalesce(d.text, own_title) END AS title
FROM linked l LEFT JOIN documents d ON d.doc_id = l.seq""".format(
        blank_title=_BLANK_TITLE
    ),
    "newest": """
SELECT * FROM (
    SELECT *, row_number() OVER (
        PARTITION BY question_id
        ORDER BY creation_date DESC NULLS LAST,
                 last_activity_date DESC NULLS LAST, message_id DESC) AS place
    FROM posts) WHERE place = 1""",
    "silver": """
SELECT question_id,
       trim(regexp_replace(regexp_replace(coalesce(title, ''),
            '[^A-Za-z0-9\\s]+', ' ', 'g'), '\\s+', ' ', 'g')) AS title_clean,
       owner_display_name AS author,
       coalesce(score, 0) AS score_filled,
       coalesce(answer_count, 0) AS answer_count_filled,
       coalesce(view_count, 0) AS view_count_filled,
       link,
       creation_date,
       make_timestamp(creation_date * 1000000) AS created_ts,
       CASE WHEN coalesce(score, 0) >= 50 AND coalesce(answer_count, 0) >= 10
                THEN 'HIGH_ENGAGEMENT'
            WHEN coalesce(score, 0) >= 20 THEN 'POSITIVE'
            WHEN coalesce(score, 0) < 0 THEN 'NEGATIVE'
            ELSE 'NEUTRAL' END AS sentiment
FROM newest
WHERE title IS NOT NULL AND regexp_matches(title, '\\S')""",
    "daily": """
SELECT CAST(created_ts AS DATE) AS report_date,
       sentiment,
       count(*) AS post_count,
       avg(score_filled) AS avg_score,
       CAST(sum(score_filled) AS BIGINT) AS total_score,
       count(DISTINCT author) AS unique_authors
FROM silver GROUP BY 1, 2""",
    "windowed": """
SELECT *,
       CAST(sum(post_count) OVER (PARTITION BY sentiment
            ORDER BY report_date NULLS FIRST
            ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT)
           AS posts_rolling_7d,
       lag(post_count) OVER (PARTITION BY sentiment
            ORDER BY report_date NULLS FIRST) AS prev_day_posts
FROM daily""",
    "gold": """
SELECT *,
       CASE WHEN prev_day_posts > 0
            THEN (post_count - prev_day_posts) / prev_day_posts * 100 END
           AS day_over_day_change_pct
FROM windowed""",
    "messages": """
SELECT *,
    CASE WHEN k = 1 THEN 'not json'
         WHEN k = 11 THEN {blank_line}
         WHEN k = 12 THEN '[1, 2]'
         ELSE '{{'
           || CASE k WHEN 2 THEN ''
                     WHEN 3 THEN '"question_id":null,'
                     WHEN 15 THEN '"question_id":"7",'
                     WHEN 19 THEN '"question_id":99999999999999999999,'
                     ELSE '"question_id":' || question_id || ',' END
           || '"title":' || CASE WHEN k = 8 THEN '5'
                ELSE coalesce(CAST(to_json(title) AS VARCHAR), 'null') END
           || ',"link":' || CAST(to_json(link) AS VARCHAR)
           || ',"score":' || CASE k WHEN 4 THEN '3000000000' WHEN 5 THEN '"x"'
                WHEN 10 THEN '5.5'
                ELSE coalesce(CAST(score AS VARCHAR), 'null') END
           || ',"answer_count":'
           || coalesce(CAST(answer_count AS VARCHAR), 'null')
           || ',"view_count":' || CASE WHEN k = 16 THEN 'true'
                ELSE CAST(view_count AS VARCHAR) END
           || ',"is_answered":' || CASE WHEN k = 14 THEN '"yes"'
                ELSE CAST(is_answered AS VARCHAR) END
           || ',"creation_date":'
           || coalesce(CAST(creation_date AS VARCHAR), 'null')
           || ',"last_activity_date":' || last_activity_date
           || ',"tags":' || CASE k WHEN 6 THEN '[1]' WHEN 7 THEN '["a",null]'
                WHEN 18 THEN '[]' ELSE CAST(to_json(tags) AS VARCHAR) END
           || ',"content_license":'
           || coalesce(CAST(to_json(content_license) AS VARCHAR), 'null')
           || ',"owner":' || CASE WHEN k = 9 THEN '{{}}' WHEN k = 13 THEN '"x"'
                WHEN NOT has_owner THEN 'null'
                ELSE '{{"account_id":' || owner_account_id
                  || ',"user_id":' || owner_user_id
                  || ',"reputation":' || owner_reputation
                  || ',"user_type":"registered","display_name":'
                  || coalesce('"' || owner_display_name || '"', 'null')
                  || ',"profile_image":null,"link":"https://example.org/u/'
                  || owner_user_id || '"}}' END
           || ',"accepted_answer_id":' || seq || '}}'
    END AS value
FROM posts""".format(blank_line=_BLANK_LINE),
    "checked": """
SELECT * REPLACE (
           CASE WHEN k = 2 THEN 0 ELSE question_id END AS question_id,
           CASE WHEN k = 18 THEN [] ELSE tags END AS tags,
           has_owner AND k <> 9 AS has_owner),
       CASE WHEN k = 1 THEN 'bad_json' WHEN k = 12 THEN 'not_object'
            WHEN k = 3 THEN 'null_id'
            WHEN k IN (4, 5, 10) THEN 'bad_type: score'
            WHEN k IN (6, 7) THEN 'bad_type: tags'
            WHEN k = 8 THEN 'bad_type: title'
            WHEN k = 13 THEN 'bad_type: owner'
            WHEN k = 14 THEN 'bad_type: is_answered'
            WHEN k IN (15, 19) THEN 'bad_type: question_id'
            WHEN k = 16 THEN 'bad_type: view_count' END AS error_reason
FROM messages WHERE k <> 11""",
    "accepted": """
SELECT *,
       CAST(json_object(
           'question_id', question_id, 'title', title, 'link', link,
           'score', score, 'answer_count', answer_count,
           'view_count', view_count, 'is_answered', is_answered,
           'creation_date', creation_date,
           'last_activity_date', last_activity_date, 'tags', tags,
           'content_license', content_license,
           'owner', CASE WHEN has_owner THEN json_object(
               'account_id', owner_account_id, 'user_id', owner_user_id,
               'reputation', owner_reputation, 'user_type', 'registered',
               'display_name', owner_display_name, 'profile_image', NULL,
               'link', 'https://example.org/u/' || owner_user_id) END
       ) AS VARCHAR) AS post_text
FROM checked WHERE error_reason IS NULL""",
    "envelopes": """
SELECT *,
       CASE WHEN k IN (60, 61, 62) THEN 'no_message'
            WHEN k IN (63, 64) THEN 'no_data' ELSE 'ok' END AS status,
       CASE WHEN k NOT IN (60, 61, 62, 63, 64, 65) THEN value END AS payload_text,
       CASE WHEN k = 60 THEN 'not json' WHEN k = 61 THEN '{}'
            WHEN k = 62 THEN '{"subscription":"s"}'
            WHEN k = 63 THEN '{"message":{"messageId":"' || message_id || '"}}'
            ELSE '{"message":{"messageId":"' || message_id || '","data":"'
              || CASE k WHEN 64 THEN '' WHEN 65 THEN '!not base64!'
                   ELSE to_base64(encode(value)) END || '"}}' END AS envelope
FROM messages""",
    "received": """
SELECT e.*, a.post_text,
       CASE WHEN e.status <> 'ok' THEN 'envelope'
            WHEN e.k = 65 THEN 'decode'
            WHEN e.k = 11 OR c.error_reason IS NOT NULL THEN 'contract'
            WHEN e.k = 53 THEN 'partition' END AS failed_stage,
       CASE WHEN e.status <> 'ok' THEN e.status
            WHEN e.k = 65 THEN 'bad_base64'
            WHEN e.k = 11 THEN 'bad_json'
            WHEN c.error_reason IS NOT NULL THEN c.error_reason
            WHEN e.k = 53 THEN 'no_creation_date' END AS failure
FROM envelopes e
LEFT JOIN checked c ON c.message_id = e.message_id
LEFT JOIN accepted a ON a.message_id = e.message_id""",
    "lines": """
SELECT event_id AS seq,
       CASE WHEN k <> 61 THEN event_type END AS key,
       CASE WHEN k = 61 THEN 'no separator here'
            ELSE 'Message ' || event_id || ' from ' || props END AS value
FROM numbered""",
    "silver_checks": """
SELECT * FROM (VALUES
    ('unique', 'question_id',
     (SELECT count(*) FROM (SELECT 1 FROM silver WHERE question_id IS NOT NULL
      GROUP BY question_id HAVING count(*) > 1))),
    ('not_null', 'question_id',
     (SELECT count(*) FROM silver WHERE question_id IS NULL)),
    ('not_null', 'title_clean',
     (SELECT count(*) FROM silver WHERE title_clean IS NULL)),
    ('not_null', 'sentiment',
     (SELECT count(*) FROM silver WHERE sentiment IS NULL)),
    ('length_between', 'title_clean',
     (SELECT count(*) FROM silver WHERE length(title_clean) NOT BETWEEN 1 AND 150)),
    ('in_set', 'sentiment',
     (SELECT count(*) FROM silver WHERE sentiment NOT IN
      ('HIGH_ENGAGEMENT', 'POSITIVE', 'NEUTRAL', 'NEGATIVE')))
) AS checks(check_name, column_name, found)""",
}

# What each expression above reads.
_NEEDS = {
    "captures": ["numbered"],
    "linked": ["captures"],
    "posts": ["linked"],
    "newest": ["posts"],
    "silver": ["newest"],
    "daily": ["silver"],
    "windowed": ["daily"],
    "gold": ["windowed"],
    "messages": ["posts"],
    "checked": ["messages"],
    "accepted": ["checked"],
    "envelopes": ["messages"],
    "received": ["envelopes", "accepted"],
    "lines": ["numbered"],
    "silver_checks": ["silver"],
}


def _with(last: str, body: str) -> str:
    """The body with every expression that ``last`` rests on before it."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    visit(last)
    parts = [f"{name} AS ({_CTES[name]})" for name in ordered]
    # A body may go on with expressions of its own.
    more = body.lstrip().removeprefix("WITH ") if body.lstrip().startswith("WITH ") else None
    start = "WITH " + ",\n".join(parts)
    return f"{start}\n{body}" if more is None else f"{start},\n{more}"


_POST_COLUMNS = """question_id, title, link, score, answer_count, view_count,
    is_answered, creation_date, last_activity_date, content_license,
    array_to_string(tags, '|') AS tags,
    CASE WHEN has_owner THEN owner_account_id END AS owner_account_id,
    CASE WHEN has_owner THEN owner_user_id END AS owner_user_id,
    CASE WHEN has_owner THEN owner_reputation END AS owner_reputation,
    CASE WHEN has_owner THEN owner_user_type END AS owner_user_type,
    CASE WHEN has_owner THEN owner_display_name END AS owner_display_name,
    NOT has_owner AS owner_missing"""

_HOUR = "strftime(make_timestamp(creation_date * 1000000), '{}')"
_HOUR_PATH = _HOUR.format("year=%Y/month=%m/day=%d/hour=%H")
_HOUR_COLUMNS = ", ".join(
    f"{_HOUR.format(form)} AS {name}"
    for name, form in [("year", "%Y"), ("month", "%m"), ("day", "%d"), ("hour", "%H")]
)
_DAYS = "report_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'"
_LATER = "publish_ts >= TIMESTAMP '2024-01-15 00:00:00'"

_TOP = """SELECT question_id, score, creation_date, last_activity_date,
    array_to_string(tags, '|') AS tags, link
FROM newest WHERE list_contains(tags, 'click')
ORDER BY {}, question_id LIMIT 100"""

_SUITE_ROW = """'20240201-000000-check' AS run_id, '{}' AS table_name, check_name,
    column_name, CAST(found AS DOUBLE) AS observed"""

_CONTRACT_NAMES = [
    "question_id", "title", "link", "score", "answer_count", "view_count",
    "is_answered", "creation_date", "last_activity_date", "tags",
    "content_license", "owner",
]

_BRONZE_CHECKS = """
SELECT {row}, low AS threshold_low, high AS threshold_high,
    (low IS NULL OR found >= low) AND (high IS NULL OR found <= high) AS passed
FROM (
    SELECT 'row_count' AS check_name, CAST(NULL AS VARCHAR) AS column_name,
           CAST(count(*) AS DOUBLE) AS found, CAST(1 AS DOUBLE) AS low,
           CAST(NULL AS DOUBLE) AS high FROM posts
    UNION ALL
    SELECT 'column_exists', name, 1, 1, 1
    FROM (SELECT unnest([{names}]) AS name)
    UNION ALL
    SELECT 'unique', 'question_id', count(*), NULL, 0
    FROM (SELECT 1 FROM posts GROUP BY question_id HAVING count(*) > 1)
    UNION ALL
    SELECT 'null_ratio', 'title', avg(CASE WHEN title IS NULL THEN 1 ELSE 0 END),
           NULL, 0.1 FROM posts
    UNION ALL
    SELECT 'null_ratio', 'score', avg(CASE WHEN score IS NULL THEN 1 ELSE 0 END),
           NULL, 0.1 FROM posts
    UNION ALL
    SELECT 'null_ratio', 'answer_count',
           avg(CASE WHEN answer_count IS NULL THEN 1 ELSE 0 END), NULL, 0.1
    FROM posts
    UNION ALL
    SELECT 'null_ratio', 'owner', avg(CASE WHEN has_owner THEN 0 ELSE 1 END),
           NULL, 0.1 FROM posts
)""".format(
    row=_SUITE_ROW.format("posts_bronze"),
    names=", ".join(f"'{name}'" for name in _CONTRACT_NAMES),
)

_SILVER_CHECKS = """
SELECT {row}, CAST(NULL AS DOUBLE) AS threshold_low,
    CAST(0 AS DOUBLE) AS threshold_high, found <= 0 AS passed
FROM silver_checks""".format(row=_SUITE_ROW.format("posts_silver"))

# Python-like type names of the fields of a message, by its number k.
_FIELD_TYPES = """
SELECT field, type, count(*) AS records FROM (
    SELECT unnest([
        {{'field': 'question_id', 'type': CASE WHEN k IN (2, 3, 12) THEN 'NoneType'
            WHEN k = 15 THEN 'str' ELSE 'int' END}},
        {{'field': 'title', 'type': CASE WHEN k = 8 THEN 'int'
            WHEN k = 12 OR title IS NULL THEN 'NoneType' ELSE 'str' END}},
        {{'field': 'link', 'type': CASE WHEN k = 12 THEN 'NoneType' ELSE 'str' END}},
        {{'field': 'score', 'type': CASE WHEN k IN (12, 23) THEN 'NoneType'
            WHEN k = 5 THEN 'str' WHEN k = 10 THEN 'float' ELSE 'int' END}},
        {{'field': 'tags', 'type': CASE WHEN k = 12 THEN 'NoneType' ELSE 'list' END}},
        {{'field': 'creation_date', 'type': CASE WHEN k IN (12, 53) THEN 'NoneType'
            ELSE 'int' END}},
        {{'field': 'owner', 'type': CASE WHEN k IN (12, 29) THEN 'NoneType'
            WHEN k = 13 THEN 'str' ELSE 'dict' END}}
    ], recursive := true)
    FROM messages WHERE k NOT IN (1, 11)
) GROUP BY field, type""".format()

_KEY_PRESENCE = """
SELECT key, count(*) AS records,
       count(*) / (SELECT count(*) FROM messages WHERE k NOT IN (1, 11, 12)) AS share
FROM (
    SELECT k, unnest([{names}, 'accepted_answer_id']) AS key
    FROM messages WHERE k NOT IN (1, 11, 12)
) WHERE NOT (k = 2 AND key = 'question_id') GROUP BY key""".format(
    names=", ".join(f"'{name}'" for name in _CONTRACT_NAMES)
)

# (path, type, condition on k, occurrences per record)
_PATHS = [
    ("$", "list", "k = 12", 1),
    ("$", "dict", "k <> 12", 1),
    ("$[]", "int", "k = 12", 2),
    ("$.question_id", "NoneType", "k = 3", 1),
    ("$.question_id", "str", "k = 15", 1),
    ("$.question_id", "int", "k NOT IN (2, 3, 12, 15)", 1),
    ("$.title", "int", "k = 8", 1),
    ("$.title", "NoneType", "k <> 12 AND title IS NULL", 1),
    ("$.title", "str", "k NOT IN (8, 12) AND title IS NOT NULL", 1),
    ("$.link", "str", "k <> 12", 1),
    ("$.score", "NoneType", "k = 23", 1),
    ("$.score", "str", "k = 5", 1),
    ("$.score", "float", "k = 10", 1),
    ("$.score", "int", "k NOT IN (5, 10, 12, 23)", 1),
    ("$.answer_count", "NoneType", "k = 17", 1),
    ("$.answer_count", "int", "k NOT IN (12, 17)", 1),
    ("$.view_count", "bool", "k = 16", 1),
    ("$.view_count", "int", "k NOT IN (12, 16)", 1),
    ("$.is_answered", "str", "k = 14", 1),
    ("$.is_answered", "bool", "k NOT IN (12, 14)", 1),
    ("$.creation_date", "NoneType", "k = 53", 1),
    ("$.creation_date", "int", "k NOT IN (12, 53)", 1),
    ("$.last_activity_date", "int", "k <> 12", 1),
    ("$.tags", "list", "k <> 12", 1),
    ("$.tags[]", "int", "k = 6", 1),
    ("$.tags[]", "NoneType", "k = 7", 1),
    ("$.tags[]", "str", "k = 7", 1),
    ("$.tags[]", "str", "k NOT IN (6, 7, 12, 18)", 2),
    ("$.content_license", "NoneType", "k = 31", 1),
    ("$.content_license", "str", "k NOT IN (12, 31)", 1),
    ("$.owner", "str", "k = 13", 1),
    ("$.owner", "NoneType", "k = 29", 1),
    ("$.owner", "dict", "k NOT IN (12, 13, 29)", 1),
    ("$.owner.account_id", "int", "k NOT IN (9, 12, 13, 29)", 1),
    ("$.owner.user_id", "int", "k NOT IN (9, 12, 13, 29)", 1),
    ("$.owner.reputation", "int", "k NOT IN (9, 12, 13, 29)", 1),
    ("$.owner.user_type", "str", "k NOT IN (9, 12, 13, 29)", 1),
    ("$.owner.display_name", "NoneType", "k = 71", 1),
    ("$.owner.display_name", "str", "k NOT IN (9, 12, 13, 29, 71)", 1),
    ("$.owner.profile_image", "NoneType", "k NOT IN (9, 12, 13, 29)", 1),
    ("$.owner.link", "str", "k NOT IN (9, 12, 13, 29)", 1),
    ("$.accepted_answer_id", "int", "k <> 12", 1),
]

_SCHEMA_PATHS = (
    "SELECT path, type, CAST(sum(records) AS BIGINT) AS occurrences FROM (\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{path}' AS path, '{kind}' AS type, {times} * count(*) AS records "
        f"FROM messages WHERE k NOT IN (1, 11) AND {test}"
        for path, kind, test, times in _PATHS
    )
    + "\n) GROUP BY path, type HAVING sum(records) > 0"
)

# Types of each path in the messages of early and late batches, where they differ.
_DRIFT = f"""
WITH earlier AS (
    SELECT path, list(type ORDER BY type) AS types
    FROM ({_SCHEMA_PATHS.replace("FROM messages", "FROM (SELECT * FROM messages WHERE k < 18)")})
    GROUP BY path
), later AS (
    SELECT path, list(type ORDER BY type) AS types
    FROM ({_SCHEMA_PATHS.replace("FROM messages", "FROM (SELECT * FROM messages WHERE k >= 18)")})
    GROUP BY path
), compared AS (
    SELECT path, e.types AS before, l.types AS after,
        CASE WHEN e.types IS NULL THEN 'new' WHEN l.types IS NULL THEN 'gone'
             WHEN e.types = l.types THEN NULL
             WHEN list_has_all(l.types, e.types) THEN 'widened'
             WHEN list_has_all(e.types, l.types) THEN 'narrowed' ELSE 'changed' END AS change
    FROM earlier e FULL JOIN later l USING (path)
)
SELECT path, change, array_to_string(before, '|') AS types_before,
    array_to_string(after, '|') AS types_after
FROM compared WHERE change IS NOT NULL"""

# Spark's type text of a message; keys come in name order.
_OWNER_SHAPE = """'OBJECT<account_id: BIGINT, display_name: '
    || CASE WHEN k = 71 THEN 'VOID' ELSE 'STRING' END
    || ', link: STRING, profile_image: VOID, reputation: BIGINT, user_id: BIGINT, '
    || 'user_type: STRING>'"""

_RECORD_SHAPES = f"""
SELECT CASE WHEN k = 12 THEN 'ARRAY<BIGINT>' ELSE
    'OBJECT<accepted_answer_id: BIGINT, answer_count: '
    || CASE WHEN k = 17 THEN 'VOID' ELSE 'BIGINT' END || ', content_license: '
    || CASE WHEN k = 31 THEN 'VOID' ELSE 'STRING' END || ', creation_date: '
    || CASE WHEN k = 53 THEN 'VOID' ELSE 'BIGINT' END || ', is_answered: '
    || CASE WHEN k = 14 THEN 'STRING' ELSE 'BOOLEAN' END
    || ', last_activity_date: BIGINT, link: STRING, owner: '
    || CASE WHEN k = 9 THEN 'OBJECT<>' WHEN k = 13 THEN 'STRING'
            WHEN k = 29 THEN 'VOID' ELSE {_OWNER_SHAPE} END
    || CASE k WHEN 2 THEN '' WHEN 3 THEN ', question_id: VOID'
              WHEN 15 THEN ', question_id: STRING'
              WHEN 19 THEN ', question_id: DECIMAL(20,0)'
              ELSE ', question_id: BIGINT' END || ', score: '
    || CASE k WHEN 23 THEN 'VOID' WHEN 5 THEN 'STRING' WHEN 10 THEN 'DECIMAL(2,1)'
              ELSE 'BIGINT' END || ', tags: '
    || CASE k WHEN 6 THEN 'ARRAY<BIGINT>' WHEN 18 THEN 'ARRAY<VOID>'
              ELSE 'ARRAY<STRING>' END || ', title: '
    || CASE WHEN k = 8 THEN 'BIGINT' WHEN title IS NULL THEN 'VOID'
            ELSE 'STRING' END || ', view_count: '
    || CASE WHEN k = 16 THEN 'BOOLEAN' ELSE 'BIGINT' END || '>' END AS shape,
    count(*) AS records
FROM messages WHERE k NOT IN (1, 11) GROUP BY 1"""

# What the types of a field merge to over all objects: one type, or VARIANT.
_MERGED_SCHEMA = """
WITH objects AS (SELECT * FROM messages WHERE k NOT IN (1, 11, 12))
SELECT 'list' AS type, 'ARRAY<BIGINT>' AS merged_schema, count(*) AS records
FROM messages WHERE k = 12 HAVING count(*) > 0
UNION ALL
SELECT 'dict', 'OBJECT<accepted_answer_id: BIGINT, answer_count: '
    || CASE WHEN bool_and(k = 17) THEN 'VOID' ELSE 'BIGINT' END || ', content_license: '
    || CASE WHEN bool_and(k = 31) THEN 'VOID' ELSE 'STRING' END || ', creation_date: '
    || CASE WHEN bool_and(k = 53) THEN 'VOID' ELSE 'BIGINT' END || ', is_answered: '
    || CASE WHEN bool_or(k = 14) THEN 'VARIANT' ELSE 'BOOLEAN' END
    || ', last_activity_date: BIGINT, link: STRING, owner: '
    || CASE WHEN bool_or(k = 13) THEN 'VARIANT' ELSE 'OBJECT<account_id: BIGINT, '
       || 'display_name: STRING, link: STRING, profile_image: VOID, reputation: BIGINT, '
       || 'user_id: BIGINT, user_type: STRING>' END || ', question_id: '
    || CASE WHEN bool_or(k = 15) THEN 'VARIANT' WHEN bool_or(k = 19) THEN 'DECIMAL(20,0)'
       ELSE 'BIGINT' END || ', score: '
    || CASE WHEN bool_or(k = 5) THEN 'VARIANT' WHEN bool_or(k = 10) THEN 'DECIMAL(11,1)'
       ELSE 'BIGINT' END || ', tags: '
    || CASE WHEN bool_or(k = 6) THEN 'ARRAY<VARIANT>' ELSE 'ARRAY<STRING>' END || ', title: '
    || CASE WHEN bool_or(k = 8) AND bool_or(k <> 8 AND title IS NOT NULL) THEN 'VARIANT'
       ELSE 'STRING' END || ', view_count: '
    || CASE WHEN bool_or(k = 16) THEN 'VARIANT' ELSE 'BIGINT' END || '>', count(*)
FROM objects HAVING count(*) > 0"""

ORACLE: dict[str, str] = {
    "bronze_posts": _with(
        "posts", f"SELECT seq, batch_id, message_id, {_POST_COLUMNS} FROM posts"
    ),
    "silver_dedup": _with(
        "newest", "SELECT question_id, message_id, creation_date, score FROM newest"
    ),
    "silver_posts": _with("silver", "SELECT * FROM silver"),
    "title_clean": _with(
        "posts",
        """SELECT message_id,
    trim(regexp_replace(regexp_replace(coalesce(title, ''),
        '[^A-Za-z0-9\\s]+', ' ', 'g'), '\\s+', ' ', 'g')) AS title_clean,
    regexp_matches(title, '\\S') AS has_text
FROM posts""",
    ),
    "sentiment_class": _with(
        "captures",
        """SELECT message_id,
    CASE WHEN coalesce(score, 0) >= 50 AND coalesce(answer_count, 0) >= 10
             THEN 'HIGH_ENGAGEMENT'
         WHEN coalesce(score, 0) >= 20 THEN 'POSITIVE'
         WHEN coalesce(score, 0) < 0 THEN 'NEGATIVE'
         ELSE 'NEUTRAL' END AS sentiment
FROM captures""",
    ),
    "epoch_convert": _with(
        "captures",
        """SELECT message_id, make_timestamp(creation_date * 1000000) AS created_ts,
    CAST(make_timestamp(creation_date * 1000000) AS DATE) AS created_date
FROM captures""",
    ),
    "gold_posts": _with("gold", "SELECT * FROM gold"),
    "gold_daily": _with("daily", "SELECT * FROM daily"),
    "gold_rolling": _with(
        "windowed", "SELECT report_date, sentiment, posts_rolling_7d FROM windowed"
    ),
    "gold_rolling_calendar": _with(
        "daily",
        """SELECT report_date, sentiment,
    CAST(sum(post_count) OVER (PARTITION BY sentiment
         ORDER BY report_date NULLS FIRST
         ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling_rows,
    CAST(sum(post_count) OVER (PARTITION BY sentiment
         ORDER BY report_date NULLS FIRST
         RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS BIGINT)
        AS rolling_calendar
FROM daily""",
    ),
    "gold_lag": _with(
        "windowed",
        "SELECT report_date, sentiment, post_count, prev_day_posts FROM windowed",
    ),
    "gold_dod": _with(
        "gold", "SELECT report_date, sentiment, day_over_day_change_pct FROM gold"
    ),
    "silver_day_partitions": _with(
        "silver",
        """SELECT CAST(created_ts AS DATE) AS created_date, sentiment,
    count(*) AS posts, CAST(sum(score_filled) AS BIGINT) AS total_score,
    CAST(sum(length(title_clean)) AS BIGINT) AS title_chars
FROM silver GROUP BY 1, 2""",
    ),
    "gold_readback_pruned": _with(
        "windowed",
        f"""SELECT report_date, sentiment, post_count, posts_rolling_7d
FROM windowed WHERE {_DAYS} AND sentiment IN ('POSITIVE', 'NEGATIVE')""",
    ),
    "trend_long": _with("daily", "SELECT report_date, sentiment, post_count FROM daily"),
    "trend_wide": _with(
        "daily",
        """SELECT report_date,
    CAST(sum(post_count) FILTER (sentiment = 'HIGH_ENGAGEMENT') AS BIGINT)
        AS HIGH_ENGAGEMENT,
    CAST(sum(post_count) FILTER (sentiment = 'POSITIVE') AS BIGINT) AS POSITIVE,
    CAST(sum(post_count) FILTER (sentiment = 'NEUTRAL') AS BIGINT) AS NEUTRAL,
    CAST(sum(post_count) FILTER (sentiment = 'NEGATIVE') AS BIGINT) AS NEGATIVE
FROM daily GROUP BY report_date""",
    ),
    "trend_date_range": _with(
        "daily", f"SELECT report_date, sentiment, post_count FROM daily WHERE {_DAYS}"
    ),
    "trend_sentiment_filter": _with(
        "daily",
        """SELECT report_date, sentiment, post_count FROM daily
WHERE sentiment IN ('HIGH_ENGAGEMENT', 'NEGATIVE')""",
    ),
    "top_posts_votes": _with("newest", _TOP.format("score DESC NULLS LAST")),
    "top_posts_activity": _with(
        "newest", _TOP.format("last_activity_date DESC NULLS LAST")
    ),
    "top_posts_creation": _with("newest", _TOP.format("creation_date ASC NULLS FIRST")),
    "filter_votes_tags": _with(
        "posts",
        """SELECT message_id, question_id, title, score,
    array_to_string(tags, '|') AS tags
FROM posts WHERE score >= 30 AND list_contains(tags, 'purchase')""",
    ),
    "contract_project": _with(
        "accepted", f"SELECT message_id, {_POST_COLUMNS} FROM accepted"
    ),
    "contract_valid": _with(
        "checked", "SELECT message_id, error_reason IS NULL AS valid FROM checked"
    ),
    "contract_reasons": _with(
        "checked",
        """SELECT CASE WHEN k = 2 THEN 'missing_id' ELSE coalesce(error_reason, 'ok') END
    AS error_reason, count(*) AS messages FROM checked GROUP BY 1""",
    ),
    "publish_main": _with(
        "accepted",
        """SELECT message_id, CAST(question_id AS VARCHAR) AS key, post_text AS value,
    'json' AS encoding, 'v1' AS schema_version, 'post-producer' AS source
FROM accepted""",
    ),
    "dead_letters": _with(
        "checked",
        """SELECT message_id, value AS raw, error_reason, 'publish' AS failed_stage,
    'post-producer' AS source, '2024-02-01T00:00:00' AS timestamp
FROM checked WHERE error_reason IS NOT NULL""",
    ),
    "publish_dead": _with(
        "checked",
        """SELECT message_id, CAST(NULL AS VARCHAR) AS key, value, error_reason,
    'publish' AS failed_stage, 'post-producer' AS source,
    '2024-02-01T00:00:00' AS timestamp
FROM checked WHERE error_reason IS NOT NULL""",
    ),
    "split_counts": _with(
        "checked",
        """SELECT CASE WHEN error_reason IS NULL THEN 'main' ELSE 'dead' END AS route,
    count(*) AS messages FROM checked GROUP BY 1""",
    ),
    "envelope_status": _with("envelopes", "SELECT seq, status FROM envelopes"),
    "envelope_decode": _with(
        "envelopes",
        "SELECT message_id, payload_text FROM envelopes WHERE status = 'ok'",
    ),
    "payload_preview": _with(
        "envelopes",
        """SELECT message_id, CAST(octet_length(encode(payload_text)) AS INTEGER) AS bytes,
    left(lower(hex(encode(payload_text))), 20) AS first_bytes
FROM envelopes WHERE payload_text IS NOT NULL""",
    ),
    "json_archive": _with(
        "accepted", "SELECT message_id, post_text AS json FROM accepted"
    ),
    "hour_partition_path": _with(
        "captures",
        f"""SELECT message_id, {_HOUR_PATH} || format('/part-{{:08d}}.parquet', question_id)
    AS path FROM captures""",
    ),
    "partitioned_readback": _with(
        "captures",
        f"""SELECT message_id, question_id, score, creation_date, {_HOUR_COLUMNS}
FROM captures""",
    ),
    "hour_partition_counts": _with(
        "captures",
        f"""SELECT {_HOUR_COLUMNS}, count(*) AS posts, max(score) AS top_score
FROM captures GROUP BY 1, 2, 3, 4""",
    ),
    "object_latest": _with(
        "captures",
        f"""SELECT {_HOUR_PATH} AS hour_path, question_id,
    arg_max(message_id, seq) AS message_id,
    list(score ORDER BY seq DESC)[1] AS score
FROM captures WHERE creation_date IS NOT NULL GROUP BY 1, 2
UNION ALL SELECT NULL, question_id, message_id, score
FROM captures WHERE creation_date IS NULL""",
    ),
    "object_lookup": _with(
        "captures",
        f"""SELECT message_id, question_id, score, {_HOUR_PATH} AS hour_path
FROM captures WHERE creation_date IS NOT NULL AND question_id IN (7, 42, 500, 901)""",
    ),
    "contract_versions": _with(
        "captures",
        """SELECT message_id, reason,
    CASE WHEN reason IS NULL THEN question_id END AS question_id,
    CASE WHEN reason IS NULL THEN own_title END AS title,
    CASE WHEN reason IS NULL THEN CAST(score AS DOUBLE) END AS score,
    CASE WHEN reason IS NULL THEN
        CASE WHEN seq % 4 = 0 THEN 'untagged' ELSE array_to_string(tags, '|') END END AS tags,
    CASE WHEN reason IS NULL THEN
        CASE WHEN seq % 4 = 2 THEN content_license ELSE 'CC BY-SA 4.0' END END
        AS content_license
FROM (SELECT *, CASE WHEN seq % 4 = 3 THEN 'unknown_version' WHEN k = 1 THEN 'bad_json'
    WHEN k = 2 THEN 'bad_type' WHEN k = 3 THEN 'missing: question_id' END AS reason
    FROM captures)""",
    ),
    "schema_drift": _with("messages", _DRIFT),
    "append_field_addition": _with(
        "captures",
        """SELECT message_id, question_id,
    CASE WHEN batch_id >= 19738 THEN content_license END AS content_license
FROM captures""",
    ),
    "topic_scan": _with(
        "checked",
        """SELECT
    CASE WHEN error_reason IS NULL AND k <> 2 THEN question_id END AS question_id,
    CASE WHEN error_reason IS NULL THEN title END AS title,
    CASE WHEN error_reason IS NULL THEN score END AS score,
    CASE WHEN error_reason IS NOT NULL THEN NULL
         ELSE coalesce(array_to_string(tags, '|'), '') END AS tags,
    CASE WHEN error_reason IS NULL THEN link END AS link,
    error_reason,
    CASE WHEN error_reason IS NOT NULL THEN value END AS raw
FROM checked""",
    ),
    "topic_write_roundtrip": _with(
        "posts",
        f"""SELECT {_POST_COLUMNS}, CAST(NULL AS VARCHAR) AS error_reason
FROM posts""",
    ),
    "topic_limit": _with(
        "messages",
        "SELECT seq, message_id, value FROM messages WHERE k <> 11 ORDER BY seq LIMIT 10",
    ),
    "topic_log_lines": _with(
        "posts",
        """SELECT message_id,
    'score=' || coalesce(CAST(score AS VARCHAR), '?') || ' title='
    || left(coalesce(title, '<no title>'), 80) || ' link=' || coalesce(link, '')
    AS log_line FROM posts""",
    ),
    "keyed_topic_scan": _with("lines", "SELECT key, value FROM lines"),
    "keyed_order": _with(
        "lines",
        """SELECT seq, key, partition,
    row_number() OVER (PARTITION BY partition ORDER BY seq) - 1 AS "offset",
    row_number() OVER (PARTITION BY partition, key ORDER BY seq) - 1 AS key_position
FROM (SELECT seq, key,
    CAST(CAST('0x' || left(md5(coalesce(key, '')), 8) AS BIGINT) % 3 AS INTEGER)
        AS partition FROM lines)""",
    ),
    "subscription_filter": _with(
        "messages",
        "SELECT message_id, value FROM messages WHERE event_type = 'purchase'",
    ),
    "subscription_start": _with(
        "captures", f"SELECT message_id, seq FROM captures WHERE {_LATER}"
    ),
    "subscription_fanout": _with(
        "messages",
        f"""SELECT 'all' AS subscription, message_id, CAST(length(value) AS INTEGER) AS chars
FROM messages
UNION ALL SELECT 'all-backup', message_id, CAST(length(value) AS INTEGER) FROM messages
UNION ALL SELECT 'later', message_id, CAST(length(value) AS INTEGER) FROM messages
    WHERE {_LATER}
UNION ALL SELECT 'clicks', message_id, CAST(length(value) AS INTEGER) FROM messages
    WHERE event_type = 'click'""",
    ),
    "dq_latest_batch": _with(
        "captures",
        """SELECT batch_id, message_id, question_id, score FROM captures
WHERE batch_id = (SELECT max(batch_id) FROM captures)""",
    ),
    "dq_unique": _with(
        "captures",
        """SELECT question_id, count(*) AS copies FROM captures
GROUP BY question_id HAVING count(*) > 1""",
    ),
    "dq_not_null": _with(
        "silver_checks",
        _SILVER_CHECKS
        + " WHERE check_name = 'not_null' AND column_name IN ('question_id', 'sentiment')",
    ),
    "dq_bronze": _with("posts", _BRONZE_CHECKS),
    "dq_silver": _with("silver_checks", _SILVER_CHECKS),
    "dq_checkpoint": _with(
        "posts",
        _BRONZE_CHECKS.replace(
            "FROM posts",
            "FROM (SELECT * FROM posts WHERE batch_id = (SELECT max(batch_id) FROM posts))",
        ),
    ),
    "key_presence": _with("messages", _KEY_PRESENCE),
    "field_types": _with("messages", _FIELD_TYPES),
    "schema_paths": _with("messages", _SCHEMA_PATHS),
    "record_shapes": _with("messages", _RECORD_SHAPES),
    "schema_merged": _with("messages", _MERGED_SCHEMA),
    "stream_ingest": _with(
        "received",
        f"""SELECT 'json' AS store, message_id, post_text AS content, 'json' AS place
FROM received WHERE failed_stage IS NULL
UNION ALL SELECT 'parquet', message_id, title, {_HOUR.format('%Y-%m-%d-%H')}
FROM received WHERE failed_stage IS NULL
UNION ALL SELECT 'table', message_id, title, 'table'
FROM received WHERE failed_stage IS NULL
UNION ALL SELECT 'dead_letters',
    CASE WHEN k NOT IN (60, 61, 62) THEN message_id END,
    envelope, failed_stage || '/' || failure
FROM received WHERE failed_stage IS NOT NULL""",
    ),
    "stream_object_latest": _with(
        "captures",
        f"""SELECT {_HOUR_PATH} AS hour_path, question_id,
    arg_max(message_id, seq) AS message_id,
    list(score ORDER BY seq DESC)[1] AS score
FROM captures WHERE creation_date IS NOT NULL GROUP BY 1, 2""",
    ),
    "gold_incremental": _with("gold", "SELECT * FROM gold"),
    "authors_by_range": _with(
        "silver",
        """WITH days AS (
    SELECT DISTINCT CAST(created_ts AS DATE) AS day FROM silver WHERE created_ts IS NOT NULL
), ranges AS (
    SELECT CAST(day - INTERVAL 6 DAYS AS DATE) AS first_day, day AS last_day FROM days
    UNION SELECT min(day), max(day) FROM days
)
SELECT first_day, last_day, count(DISTINCT author) AS authors
FROM ranges JOIN silver ON CAST(created_ts AS DATE) BETWEEN first_day AND last_day
GROUP BY 1, 2""",
    ),
    "stream_archive_latest": _with(
        "received",
        "SELECT message_id, post_text AS json FROM received WHERE failed_stage IS NULL",
    ),
    "stream_dead_letters": _with(
        "checked",
        """SELECT value AS raw, error_reason, 'publish' AS failed_stage,
    'post-producer' AS source
FROM checked WHERE error_reason IS NOT NULL""",
    ),
    "stream_routing": _with(
        "checked",
        """SELECT CASE WHEN error_reason IS NULL THEN 'main' ELSE 'dead' END AS route,
    split_part(error_reason, ':', 1) AS reason, count(*) AS messages
FROM checked GROUP BY 1, 2""",
    ),
    "stream_dedup": _with("messages", "SELECT message_id, value FROM messages"),
    "stream_first_deliveries": _with(
        "messages", "SELECT message_id, value FROM messages"
    ),
}

# Other ways to the same rows.
ORACLE |= {
    "stream_ingest_committed": ORACLE["stream_ingest"],
    "stream_fanout": ORACLE["subscription_fanout"],
    "stream_keyed_order": ORACLE["keyed_order"],
    "stream_checks": f"SELECT * FROM ({ORACLE['dq_bronze']}) WHERE check_name <> 'unique'",
    "stream_subscription_start": ORACLE["subscription_start"],
}
