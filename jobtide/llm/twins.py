"""The same results in DuckDB SQL, where SQL can say them."""

from __future__ import annotations

from jobtide.llm import quality_rules as q

COUNTS = rf"""
raw AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
texts AS (SELECT r, doc_id, t,
    list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM raw),
windows AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM texts)),
again AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r),
counts AS (SELECT doc_id, len(w)::BIGINT AS n_words,
    list_sum(list_transform(w, lambda x: length(x)))::BIGINT AS chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines,
    length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
    length(regexp_replace(t, '[^!]', '', 'g'))::BIGINT AS n_marks,
    len(list_intersect(list_distinct(w), {q.COMMON!r}))::BIGINT AS n_common
  FROM texts LEFT JOIN covered c USING (r)),
votes AS (SELECT * EXCLUDE (chars, word_chars), word_chars, {{votes}}
  FROM (SELECT *, coalesce(chars, 0) AS word_chars FROM counts))"""


def quality_rules() -> str:
    """The rounds of the estimate as one row each: share s, accuracies g and b of each rule."""
    rules = range(len(q.RULES))
    votes = ", ".join(f"{rule} AS v{j}" for j, rule in enumerate(q.RULES.values()))
    start = f"{q.GOOD}::DOUBLE AS s, " + ", ".join(
        f"{q.START[0]}::DOUBLE AS g{j}, {q.START[1]}::DOUBLE AS b{j}" for j in rules)
    odds = "ln(s / (1 - s))" + "".join(
        f" + CASE WHEN v{j} < 0 THEN ln((1 - g{j}) / b{j}) WHEN v{j} > 0 THEN ln(g{j} / (1 - b{j})) ELSE 0 END"
        for j in rules)

    def part(value: float, mass: str, hit: str, seen: str) -> str:
        return (f"({value * q.PRIOR} + coalesce(sum({mass}) FILTER (WHERE {hit}), 0))"
                f" / ({q.PRIOR} + coalesce(sum({mass}) FILTER (WHERE {seen}), 0))")

    every = f"({q.GOOD * q.PRIOR} + coalesce(sum(n * p), 0)) / ({q.PRIOR} + coalesce(sum(n), 0)) AS s"
    each = ", ".join([every, *[
        f"{part(q.START[0], 'n * p', f'v{j} > 0', f'v{j} <> 0')} AS g{j}, "
        f"{part(q.START[1], 'n * (1 - p)', f'v{j} < 0', f'v{j} <> 0')} AS b{j}" for j in rules]])
    rounds = "".join(
        f",\nr{k + 1} AS (SELECT {each} FROM (SELECT *, 1 / (1 + exp(-({odds}))) AS p FROM patterns, r{k}))"
        for k in range(q.ROUNDS))
    return f"""WITH {COUNTS.replace("{votes}", votes)},
patterns AS MATERIALIZED (SELECT {", ".join(f"v{j}" for j in rules)}, count(*) AS n FROM votes GROUP BY ALL),
r0 AS (SELECT {start}){rounds}
SELECT doc_id, {", ".join(q.COUNTS)}, {q.BASE_FAILED} AS base_failed,
  NOT {q.BASE_FAILED} AND ({odds}) >= 0 AS kept FROM votes, r{q.ROUNDS}"""


def warc() -> str:
    """Base 32 from the 40 hexadecimal digits of SHA-1, 5 bits at a time."""
    digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return f"""WITH pages_ AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
hashed AS (SELECT page_id, strlen(t)::BIGINT AS payload_bytes, sha1(t) AS h FROM pages_),
coded AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32),
    lambda k: '{digits}'[(('0x' || h[(k // 4) * 5 + 1 : (k // 4) * 5 + 5])::BIGINT >> (15 - 5 * (k % 4))) % 32 + 1]),
    '') AS payload_digest FROM hashed),
firsts AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS f FROM coded)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = f THEN NULL ELSE f END AS refers_to FROM firsts"""


def crc32(text: str) -> str:
    """CRC-32 of a text of ASCII characters: `steps` of `crc_table` are the 256 steps (see CRC_TABLE)."""
    return (f"""xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length({text}) + 1),
    lambda k: ascii(substr({text}, k::INT, 1))::BIGINT), lambda c, b: xor(c >> 8, steps[
    (xor(c, b) & 255) + 1])), 4294967295)""")


_STEP = "CASE WHEN {c} & 1 = 1 THEN xor({c} >> 1, 3988292384) ELSE {c} >> 1 END"
_ROUNDS = ["", *[f"list_transform({{}}, lambda c: {_STEP.format(c='c')})"] * 8]
CRC_TABLE = "range(256)"
for _round in _ROUNDS[1:]:
    CRC_TABLE = _round.format(CRC_TABLE)
CRC_TABLE = f"crc_table AS MATERIALIZED (SELECT {CRC_TABLE} AS steps)"


def merkle_manifest() -> str:
    """Levels of both trees by recursion, then the runs on the way up from each leaf."""
    def leaf(text: str) -> str:
        parts = [f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in (
            "doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)]
        return f"sha256({' || '.join(parts)})"

    return f"""WITH RECURSIVE {CRC_TABLE},
hashed AS (SELECT row_number() OVER () AS r, doc_id, source, {leaf("text")} AS leaf,
    CASE WHEN {crc32("doc_id::VARCHAR")} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")}
      ELSE {leaf("text")} END AS now FROM documents, crc_table),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n FROM hashed),
up AS (SELECT 0 AS h, source, i, leaf AS d, n FROM placed
  UNION ALL SELECT h + 1, source, i // 3, sha256(string_agg(d, '' ORDER BY i)), (n + 2) // 3
  FROM up WHERE n > 1 GROUP BY h, source, i // 3, n),
subroots AS (SELECT source, d, h AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i,
    count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS h, i, d, n FROM subroots
  UNION ALL SELECT h + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)), (n + 2) // 3
  FROM top WHERE n > 1 GROUP BY h, i // 3, n),
root AS (SELECT d AS root, h AS height FROM top WHERE n = 1),
levels AS (SELECT p.r, p.source, s.d AS subroot, s.i AS s, p.i, s.height, unnest(range(0, s.height + root.height)) AS k
  FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source, root),
nodes AS (SELECT r, k, CASE WHEN k < height THEN source END AS source, k < height AS low,
    CASE WHEN k < height THEN k ELSE k - height END AS h,
    CASE WHEN k < height THEN i // (3 ** k)::BIGINT ELSE s // (3 ** (k - height))::BIGINT END AS i FROM levels),
every AS (SELECT true AS low, h, source, i, d FROM up UNION ALL SELECT false, h, NULL, i, d FROM top),
runs AS (SELECT n.r, n.k, coalesce(string_agg(e.d, '' ORDER BY e.i) FILTER (WHERE e.i < n.i), '') AS before,
    coalesce(string_agg(e.d, '' ORDER BY e.i) FILTER (WHERE e.i > n.i), '') AS after
  FROM nodes n JOIN every e ON n.low = e.low AND n.h = e.h AND n.source IS NOT DISTINCT FROM e.source
    AND n.i // 3 = e.i // 3 GROUP BY n.r, n.k),
proof AS (SELECT r, sha256(string_agg(before || after, '' ORDER BY k)) AS p FROM runs GROUP BY r),
folds AS (SELECT r, 0 AS k, now AS d FROM placed
  UNION ALL SELECT f.r, f.k + 1, sha256(x.before || f.d || x.after) FROM folds f JOIN runs x ON f.r = x.r AND f.k = x.k),
last AS (SELECT r, arg_max(d, k) AS d FROM folds GROUP BY r)
SELECT doc_id, leaf, s.d AS subroot, root, coalesce(p, sha256('')) AS proof_sha256, last.d AS folded_root,
  last.d = root AS verified
FROM placed JOIN subroots s ON placed.source IS NOT DISTINCT FROM s.source JOIN last USING (r)
  LEFT JOIN proof USING (r), root"""


def conversation_repair() -> str:
    """From the last row to the first, the least edits to the end from each state: eight digits of
    cost, then the letters, so that the least text is the cheapest and then the least of these."""
    def step(text: str, letter: str, cost: str) -> str:
        return f"lpad((left({text}, 8)::INT + {cost})::VARCHAR, 8, '0') || '{letter}' || substr({text}, 9)"

    def rows(state: str, keeps: dict[str, str], other: str) -> str:
        keep = " ".join(f"WHEN c = '{c}' THEN {step(to, 'K', 'late')}" for c, to in keeps.items())
        return (f"least({step(state, 'D', '4')}, CASE WHEN gone THEN NULL {keep} END, "
                f"CASE WHEN NOT gone THEN {step(other, 'R', '3 + late')} END)")

    return f"""WITH RECURSIVE {CRC_TABLE},
drawn AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS d
  FROM conversations, crc_table),
damaged AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy FROM drawn WHERE d <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS e FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM placed),
found AS (SELECT *, left(role, 1) AS c, CASE WHEN e = '' THEN 'blank' WHEN again THEN 'duplicate'
    WHEN e NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM seen),
arcs AS (SELECT conv_id, i, c, coalesce(fault IN ('blank', 'duplicate'), false) AS gone,
    CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS late FROM found),
sizes AS (SELECT conv_id, max(i) AS n FROM found GROUP BY conv_id),
back AS (SELECT conv_id, n AS i, '00000000' AS z, '00000006II' AS s, '00000003I' AS u, '00000000' AS a FROM sizes
  UNION ALL SELECT conv_id, i, least(z, {step("least(u, " + step("a", "I", "3") + ")", "I", "3")}),
    least(s, {step("least(u, " + step("a", "I", "3") + ")", "I", "3")}), least(u, {step("a", "I", "3")}),
    least(a, {step("u", "I", "3")})
  FROM (SELECT b.conv_id, b.i - 1 AS i, {rows("z", {"s": "s", "u": "u"}, "u")} AS z, {rows("s", {"u": "u"}, "u")} AS s,
      {rows("u", {"a": "a"}, "a")} AS u, {rows("a", {"u": "u"}, "u")} AS a
    FROM back b JOIN arcs r ON b.conv_id IS NOT DISTINCT FROM r.conv_id AND b.i = r.i)),
best AS (SELECT conv_id, left(z, 8)::BIGINT AS cost, substr(z, 9) AS audit FROM back WHERE i = 0),
edits AS (SELECT conv_id, k, audit[k] AS x, len(replace(left(audit, k), 'I', '')) AS i,
    len(replace(left(audit, k), 'D', '')) - len(replace(audit, 'D', '')) % 2 AS p
  FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS k FROM best)),
kept AS (SELECT t.conv_id, k, CASE WHEN x = 'K' THEN role WHEN p % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN x = 'I' THEN '' ELSE text END AS line
  FROM edits t LEFT JOIN found f ON t.conv_id IS NOT DISTINCT FROM f.conv_id AND t.i = f.i WHERE x <> 'D'),
digests AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY k)) AS h FROM kept GROUP BY conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM found GROUP BY conv_id)
SELECT o.conv_id, {", ".join(f"coalesce({c}, 0)::BIGINT AS {c}" for c in (
    "gaps", "blank", "duplicate", "truncated", "illegal", "cost"))},
  coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
  LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
  LEFT JOIN digests g ON o.conv_id IS NOT DISTINCT FROM g.conv_id"""


def chat_format() -> str:
    """Turns, learned text and formatted signs of each conversation, without a prefix tree."""
    def escaped(text: str) -> str:
        text = f"replace({text}, '\\', '\\\\')"
        for c in ("<s>", "</s>", "[INST]", "[/INST]"):
            text = f"replace({text}, '{c}', '{c[0]}\\{c[1:]}')"
        return text

    said = f"length('<s>[INST][/INST]</s>') + length({escaped('role')}) + length({escaped('text')})"
    return f"""WITH every AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
placed AS (SELECT *, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(role || chr(10) || text)) AS i FROM every),
learned AS (SELECT conv_id, coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '') AS t
  FROM placed GROUP BY conv_id)
SELECT p.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  any_value(length(t)) AS loss_chars, any_value(sha256(t)) AS loss_sha256, sum({said})::BIGINT AS formatted_chars
FROM placed p JOIN learned l ON p.conv_id IS NOT DISTINCT FROM l.conv_id GROUP BY p.conv_id"""
