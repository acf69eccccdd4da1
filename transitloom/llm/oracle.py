"""The corpus queries in DuckDB's SQL, where SQL can express them."""

from __future__ import annotations

import re

from transitloom.llm.chat_format import CONTROL_STRINGS, END, START
from transitloom.llm.license_scan import REWRITES, SPELLINGS
from transitloom.llm.license_texts import KNOWN_TEXTS
from transitloom.llm.queries import AWKWARD_TURNS, SHARD_BYTES
from transitloom.llm.sharding import HASH_BITS

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _decontaminate() -> str:
    def words(table: str, key: str) -> str:
        lower = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"
        return (
            f"SELECT {key}, coalesce(regexp_extract_all({lower}, '{_WORD}'), []) AS words FROM {table}"
        )

    return f"""
    WITH items AS ({words("benchmark", "item_id")}),
    docs AS ({words("documents", "doc_id")}),
    windows AS (
        SELECT DISTINCT item_id, array_to_string(words[i : i + 12], ' ') AS w,
            least(len(words), 13) AS n
        FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i
              FROM items WHERE len(words) > 0)
    ),
    places AS (
        SELECT doc_id, i, n, array_to_string(words[i : i + n - 1], ' ') AS w
        FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
              FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n)
    ),
    found AS (SELECT DISTINCT doc_id, i, n, item_id FROM places JOIN windows USING (w, n)),
    hits AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
    ),
    named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
    )
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
        coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
    FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
    """


def _line_dedup(min_words: int = 50) -> str:
    blanks = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
    return rf"""
    WITH split AS (
        SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents
    ),
    lines AS (
        SELECT doc_id, no, trim(part, {blanks}) AS line
        FROM (SELECT doc_id, unnest(parts) AS part, unnest(range(len(parts))) AS no FROM split)
    ),
    filled AS (
        SELECT doc_id, no, line, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS i,
            len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w
        FROM lines WHERE line <> ''
    ),
    summed AS (
        SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM filled
    ),
    texts AS (SELECT doc_id, list(line ORDER BY i) AS all_lines FROM filled GROUP BY doc_id),
    reach AS (
        SELECT a.doc_id, a.i AS i, b.i AS j FROM summed a JOIN summed b
        ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + {min_words - 1}
        AND b.upto - a.upto + a.w >= {min_words}
    ),
    runs AS (
        SELECT doc_id, i, min(j) AS j FROM reach GROUP BY doc_id, i
        UNION
        SELECT doc_id, max(i) AS i, j FROM reach GROUP BY doc_id, j
    ),
    keyed AS (
        SELECT doc_id, i, j, j - i AS n, array_to_string(all_lines[i : j], chr(10)) AS run
        FROM runs JOIN texts USING (doc_id)
    ),
    later AS (
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY n, run ORDER BY doc_id, i) AS place FROM keyed
        ) WHERE place > 1
    ),
    gone AS (
        SELECT DISTINCT f.doc_id, f.no FROM later l JOIN filled f
        ON f.doc_id = l.doc_id AND f.i BETWEEN l.i AND l.j
    ),
    kept AS (
        SELECT s.doc_id, list(g.no) FILTER (g.no IS NOT NULL) AS numbers
        FROM split s LEFT JOIN gone g USING (doc_id) GROUP BY s.doc_id
    ),
    result AS (
        SELECT doc_id, len(parts)::BIGINT AS n_lines, coalesce(len(numbers), 0)::BIGINT AS n_removed,
            array_to_string([x FOR x, k IN parts IF numbers IS NULL OR NOT list_contains(numbers, k - 1)],
                chr(10)) AS text
        FROM split JOIN kept USING (doc_id)
    )
    SELECT doc_id, n_lines, n_removed, sha256(text) AS kept_sha256, length(text)::BIGINT AS kept_chars
    FROM result
    """


def _canonical(text: str) -> str:
    plain = f"lower({text})"
    for pattern, replacement in REWRITES:
        pattern = pattern.replace("'", "''")
        plain = f"regexp_replace({plain}, '{pattern}', '{replacement.replace('$', chr(92))}', 'g')"
    for spelling, usual in SPELLINGS:
        plain = f"replace({plain}, '{spelling}', '{usual}')"
    return f"[trim(x, ' ') FOR x IN string_split({plain}, chr(10)) IF trim(x, ' ') <> '']"


def _license_scan() -> str:
    rows = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in KNOWN_TEXTS)
    return f"""
    WITH given(license_id, text) AS (VALUES {rows}),
    known AS (
        SELECT string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS license, digest
        FROM (SELECT license_id, md5(array_to_string({_canonical("text")}, ' ')) AS digest FROM given)
        GROUP BY digest
    ),
    docs AS (SELECT doc_id, {_canonical("text")} AS lines FROM documents),
    units AS (
        SELECT doc_id, unnest([md5(x) FOR x IN lines]) AS digest FROM docs
    ),
    notices AS (
        SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(*) AS n
        FROM units JOIN known USING (digest) GROUP BY doc_id
    )
    SELECT d.doc_id, md5(array_to_string(d.lines, ' ')) AS text_digest, k.license,
        coalesce(n.notices, '') AS notices, coalesce(n.n, 0)::BIGINT AS n_notice_lines
    FROM docs d LEFT JOIN known k ON k.digest = md5(array_to_string(d.lines, ' '))
    LEFT JOIN notices n ON n.doc_id = d.doc_id
    """


_EXACT_DEDUP = """
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
    FROM (
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    )
"""


def _shard() -> str:
    # The shortest prefix, from the first directory on, whose bucket fits or is one hash.
    return f"""
    WITH sized AS (
        SELECT doc_id, coalesce(strlen(text), 0) + 32 AS size,
            ('0x' || md5(coalesce(doc_id::VARCHAR, chr(0) || 'null') || chr(0)
                || coalesce(text, chr(0) || 'null'))[1:{HASH_BITS // 4}])::BIGINT AS bits
        FROM documents
    ),
    base AS (
        SELECT (SELECT count(*) FROM range(1, {HASH_BITS} + 1) r(k)
                WHERE {SHARD_BYTES}::HUGEINT * (1::HUGEINT << k::INT) <= total) AS depth
        FROM (SELECT coalesce(sum(size), 0) AS total FROM sized)
    ),
    levels AS (
        SELECT doc_id, size, bits, k AS depth, bits >> ({HASH_BITS} - k) AS prefix
        FROM sized, base, range(0, {HASH_BITS} + 1) r(k) WHERE k >= base.depth
    ),
    buckets AS (
        SELECT depth, prefix FROM levels GROUP BY depth, prefix
        HAVING sum(size) <= {SHARD_BYTES} OR min(bits) = max(bits)
    )
    SELECT doc_id, 'b' || lpad(bin(min_by(prefix, depth)), min(depth)::INT, '0') AS shard,
        any_value(size)::BIGINT AS size
    FROM levels JOIN buckets USING (depth, prefix) GROUP BY doc_id
    """


def _chat_format() -> str:
    given = ", ".join(
        f"({conv}, {turn}, {_quoted(role)}, {_quoted(text)})" for conv, turn, role, text in AWKWARD_TURNS
    )
    like = "|".join(f"{re.escape(s[0])}\\\\*{re.escape(s[1:])}" for s in CONTROL_STRINGS)
    around = len(START) + len("\n") + len(END) + len("\n")
    return f"""
    WITH turns AS (
        SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT * FROM (VALUES {given})
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), ''))
            AS loss_sha256,
        sum({around} + length(role) + length(text)
            + len(regexp_extract_all(text, '{like}')))::BIGINT AS formatted_chars
    FROM turns GROUP BY conv_id
    """


_CRC_TABLE = """
    crc_table AS (
        SELECT list(list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
        FROM range(256) r(i)
    )"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's bytes, where ``crc_table`` is in reach."""
    code = f"hex(encode({text}))"
    octets = f"[('0x' || {code}[2 * k + 1 : 2 * k + 2])::BIGINT FOR k IN range(len({code}) // 2)]"
    return f"""xor(list_reduce([4294967295::BIGINT] || {octets}, lambda c, b:
        xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"""


def _spelling_variants() -> str:
    lower = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"
    return rf"""
    WITH RECURSIVE {_CRC_TABLE},
    runs AS (
        SELECT coalesce(doc_id::VARCHAR, '') AS id,
            unnest(regexp_extract_all({lower}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
    ),
    counted AS (
        SELECT run, count(*) AS times, {_crc32("id || ':' || run")} AS code
        FROM runs, crc_table WHERE length(run) >= 7 GROUP BY id, run, t
    ),
    words AS (
        SELECT word, sum(times)::BIGINT AS n
        FROM (SELECT times, CASE WHEN code % 31 = 0
                  THEN run[: code % length(run)] || run[code % length(run) + 2 :] ELSE run END AS word
              FROM counted)
        WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
    ),
    cuts AS (
        SELECT word, n, k, word[: k - 1] || word[k + 1 :] AS cut
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)
    ),
    pairs AS (
        SELECT a.word, b.word AS near, b.n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.k = b.k
        WHERE a.word <> b.word
        UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON b.word = a.cut
        UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON b.word = a.cut
    ),
    best AS (
        SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS near, max(n) AS near_n
        FROM pairs GROUP BY word
    ),
    formed AS (
        SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form,
            CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
        FROM words w LEFT JOIN best USING (word)
    ),
    ways(word, root) AS (
        SELECT word, word FROM formed
        UNION ALL SELECT w.word, f.form FROM ways w JOIN formed f ON f.word = w.root
        WHERE f.form IS NOT NULL
    )
    SELECT word, form, root, f.n, n_near, form_n
    FROM formed f JOIN (SELECT w.word, w.root FROM ways w JOIN formed e ON e.word = w.root
                        WHERE e.form IS NULL) USING (word)
    """


def _conversation_repair() -> str:
    def edit(cost: str, letter: str, line: str = "''"):
        return lambda state: (
            f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {line}}}"
        )

    def turn_of(role: str) -> str:
        return f"'{role}:' || chr(10)"

    def cheapest(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    def allowed(condition: str, option: str) -> str:
        return f"CASE WHEN stays AND {condition} THEN {option} END"

    delete, keep = edit("4", "D"), edit("extra", "K", "role || ':' || text || chr(10)")
    to_user = edit("extra + 3", "R", "'user:' || text || chr(10)")
    to_assistant = edit("extra + 3", "R", "'assistant:' || text || chr(10)")
    add_user, add_assistant = edit("3", "I", turn_of("user")), edit("3", "I", turn_of("assistant"))
    before_user = ("s0", "s1", "s3")
    kept = [allowed("initial = 'u'", keep(state)) for state in before_user]
    changed = [allowed("true", to_user(state)) for state in before_user]
    never = "{'c': 1000000000::BIGINT, 'a': '', 't': ''}"
    nothing = "{'c': 0::BIGINT, 'a': '', 't': ''}"
    return rf"""
    WITH RECURSIVE {_CRC_TABLE},
    dealt AS (
        SELECT coalesce('c' || conv_id, 'null') AS talk, turn, coalesce(role, ' ') AS role,
            coalesce(text, ' ') AS text,
            {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS n
        FROM conversations, crc_table
    ),
    damaged AS (
        SELECT talk, turn, CASE WHEN n = 4 THEN 'user' ELSE role END AS role,
            CASE n WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM (SELECT *, unnest(CASE WHEN n = 3 THEN [1, 2] ELSE [1] END) FROM dealt WHERE n > 0)
    ),
    numbered AS (
        SELECT *, left(role, 1) AS initial,
            row_number() OVER (PARTITION BY talk ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
            regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS ending
        FROM damaged
    ),
    judged AS (
        SELECT *, ending = '' AS blank, ending <> '' AND seen > 1 AS duplicate,
            ending <> '' AND seen = 1 AND ending NOT IN ('.', '!', '?') AS truncated,
            ending <> '' AND seen = 1 AS stays, CASE WHEN truncated THEN 3 ELSE 0 END AS extra,
            coalesce(before || initial NOT IN ('su', 'ua', 'au'), false) AS illegal
        FROM (SELECT *, row_number() OVER (PARTITION BY talk, role, text ORDER BY i) AS seen,
                  lag(initial) OVER (PARTITION BY talk ORDER BY i) AS before
              FROM numbered)
    ),
    counts AS (
        SELECT talk, count(*) AS n,
            coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
            count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
            count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
        FROM judged GROUP BY talk
    ),
    ways AS (
        SELECT talk, 0::BIGINT AS i, {nothing} AS s0, {never} AS s1, {add_user(nothing)} AS s2,
            {add_assistant(add_user(nothing))} AS s3 FROM counts
        UNION ALL
        SELECT talk, i, s0, s1, s2, {cheapest("s3", add_assistant("s2"))}
        FROM (SELECT talk, i, s0, s1, s3,
                  {cheapest("s2", *[add_user(state) for state in before_user])} AS s2
              FROM (SELECT w.talk, j.i, {delete("s0")} AS s0,
                        {cheapest(delete("s1"), allowed("initial = 's'", keep("s0")))} AS s1,
                        {cheapest(delete("s2"), *kept, *changed)} AS s2,
                        {cheapest(delete("s3"), allowed("initial = 'a'", keep("s2")),
                                  allowed("true", to_assistant("s2")))} AS s3
                    FROM ways w JOIN judged j ON j.talk = w.talk AND j.i = w.i + 1))
    ),
    best AS (
        SELECT c.*, list_min([s0, s3]) AS way FROM ways w JOIN counts c ON c.talk = w.talk AND w.i = c.n
    )
    SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
        coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
        coalesce(illegal, 0) AS illegal, coalesce(way.c, 0) AS cost, coalesce(way.a, '') AS audit,
        sha256(coalesce(left(way.t, -1), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o
    LEFT JOIN best b ON b.talk = coalesce('c' || o.conv_id, 'null')
    """


def corpus_oracles() -> dict[str, str]:
    """By query name. Not here: draws by Spark's hash (2), learnt models (7, 11), XXH64 (8) and
    parsing pages (10); tests hold these against brute force."""
    return {
        "op1_decontaminate": _decontaminate(),
        "op3_line_dedup": _line_dedup(),
        "op4_license_scan": _license_scan(),
        "op5_exact_dedup": _EXACT_DEDUP,
        "op6_shard": _shard(),
        "op9_chat_format": _chat_format(),
        "op12_spelling_variants": _spelling_variants(),
        "op13_conversation_repair": _conversation_repair(),
    }
