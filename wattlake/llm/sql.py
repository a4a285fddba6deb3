"""SQL that gives the same rows as the queries which SQL can express, made for DuckDB."""

from __future__ import annotations

from functools import reduce

from wattlake.llm import chats, licences, merkle, pii
from wattlake.llm.licence_texts import NOTICES, TEXTS


def _luhn(number: str) -> str:
    """Luhn over a string of digits: places from the right, every second digit doubled."""
    digit = f"(reverse({number})[i])::INT"
    return (f"list_sum(list_transform(range(1, length({number}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN {digit} "
            f"WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END)) % 10 = 0")


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_CARD = "CASE WHEN length({0}) BETWEEN {1} AND 19 THEN {2} ELSE false END"
_ACCOUNT = "replace(m, ' ', '')"
_MOD97 = (f"CASE WHEN length({_ACCOUNT}) BETWEEN 15 AND 34 THEN list_reduce(list_prepend(0::BIGINT, list_transform("
          f"string_split(substr({_ACCOUNT}, 5) || {_ACCOUNT}[1:4], ''), lambda c: (CASE WHEN c BETWEEN '0' AND '9' THEN "
          "ascii(c) - 48 ELSE ascii(c) - 55 END)::BIGINT)), lambda r, x: CASE WHEN x < 10 THEN (r * 10 + x) % 97 "
          "ELSE (r * 100 + x) % 97 END) = 1 ELSE false END")
_VALID = {
    "ip": "list_max(list_transform(string_split(m, '.'), lambda p: p::HUGEINT)) <= 255",
    "card": _CARD.format(_DIGITS, 14, _luhn(_DIGITS)),
    "lone_card": _CARD.format(_DIGITS, 13, _luhn(_DIGITS)),
    "phone": f"length({_DIGITS}) BETWEEN 10 AND 15",
    "iban": _MOD97,
    "secret": "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')",
}


def _spans(rank: int, kind: pii.Kind) -> str:
    around = f"right(pieces[i], {pii.CONTEXT}) || ' ' || left(pieces[i + 1], {pii.CONTEXT})"
    raised = f"CASE WHEN regexp_matches({around}, '{pii.word_pattern(kind.near)}') THEN {pii.RAISE}::DOUBLE ELSE 0 END"
    lowered = f"CASE WHEN regexp_matches({around}, '{pii.word_pattern(kind.against)}') THEN {pii.LOWER}::DOUBLE ELSE 0 END"
    kept = "true" if kind.base else f"{kind.score}::DOUBLE + {raised} - {lowered} >= 0.5"
    return f"""
SELECT doc_id, {rank} AS r, '{kind.name}' AS kind, e - length(m) AS s, e FROM (
  SELECT *, list_sum(list_transform(found[1:i], lambda x: length(x)))
            + list_sum(list_transform(pieces[1:i], lambda x: length(x))) AS e, found[i] AS m
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM (
    SELECT doc_id, string_split_regex(t, '{kind.plain}') AS pieces, regexp_extract_all(t, '{kind.plain}') AS found
    FROM texts)))
WHERE {_VALID.get(kind.name, 'true')} AND {kept}"""


def personal_data() -> str:
    parts = "\nUNION ALL".join(_spans(i, k) for i, k in enumerate(pii.KINDS))
    listed = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, r)"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in pii.BASE)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
proposed AS ({parts}),
spans AS (SELECT * FROM proposed p WHERE kind <> 'lone_card' OR NOT EXISTS (
  SELECT 1 FROM proposed c WHERE c.doc_id = p.doc_id AND c.kind = 'card' AND c.s <= p.s AND c.e >= p.e))
SELECT d.doc_id, {counts}, sha256(coalesce({listed} FILTER (r < {len(pii.BASE)}), '')) AS base_sha256,
       coalesce({listed}, '') AS spans
FROM documents d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id"""


TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5"""


def _tree(text: str) -> str:
    """The Merkle tree of a text as struct(root, fingerprint, keys)."""
    section, paragraph = r"\n+|(?:[^\n]+\n?)+\n*", r"[^\n]*\n|[^\n]+"
    key = (f"(('0x' || md5(x)[1:{merkle.HASH_BITS // 4}])::BIGINT * {1 << merkle.LENGTH_BITS} "
           f"+ least(length(x), {(1 << merkle.LENGTH_BITS) - 1}))")
    leaves = f"regexp_extract_all(p, '{merkle.SENTENCE}')"
    paragraphs = f"regexp_extract_all(s, '{paragraph}')"
    sections = f"regexp_extract_all({text}, '{section}')"
    each = lambda items, name, body: f"list_transform({items}, lambda {name}: {body})"
    joined = lambda items, by="": f"coalesce(array_to_string({items}, '{by}'), '')"
    of_paragraph = f"md5({joined(each(leaves, 'x', 'md5(x)'))})"
    of_section = f"md5({joined(each(paragraphs, 'p', of_paragraph))})"
    root = f"md5({joined(each(sections, 's', of_section))})"
    written = joined(each(sections, "s", joined(each(paragraphs, "p", joined(
        each(leaves, "x", f"printf('%012x', {key})"))), ",")), ";")
    keys = f"flatten(flatten({each(sections, 's', each(paragraphs, 'p', each(leaves, 'x', key)))}))"
    return f"{{'root': {root}, 'fingerprint': {root} || ':' || {written}, 'keys': {keys}}}"


def _likeness(a: str, b: str) -> str:
    weight = lambda keys: f"coalesce(list_sum(list_transform({keys}, lambda k: k % {1 << merkle.LENGTH_BITS})), 0)"
    larger = f"greatest({weight(f'list_distinct({a}.keys)')}, {weight(f'list_distinct({b}.keys)')})"
    return (f"CASE WHEN {a}.root = {b}.root THEN 1.0::DOUBLE "
            f"ELSE {weight(f'list_intersect({a}.keys, {b}.keys)')}::DOUBLE / ({larger} + 1) END")


def fingerprints() -> str:
    return f"""
WITH rows AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
followed AS (SELECT doc_id, t, coalesce(lead(t) OVER w, first_value(t) OVER w) AS following FROM rows
             WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, t)),
spliced AS (SELECT *, length(t) // 3 AS n, left(t, length(t) - length(t) // 3) || left(following, length(t) // 3) AS edited
            FROM followed),
trees AS (SELECT *, {_tree('t')} AS a, {_tree('edited')} AS b, {_tree('following')} AS c FROM spliced)
SELECT doc_id, length(t) AS n_chars, sha256(edited) AS edited_sha256, a.fingerprint AS fingerprint,
       b.fingerprint AS edited_fingerprint, {_likeness('a', 'b')} AS near_edited, {_likeness('a', 'c')} AS near_next
FROM trees"""


def _canonical_lines(text: str) -> str:
    value = f"lower(coalesce({text}, ''))"
    for pattern in (licences.COMMENT_MARKS, licences.COPYRIGHT_LINES):
        value = f"regexp_replace({value}, '{pattern.replace('(?dm)', '(?m)')}', ' ', 'g')"
    value = reduce(lambda v, pair: f"replace({v}, '{pair[0]}', '{pair[1]}')", licences.SPELLINGS, value)
    value = f"regexp_replace({value}, '{licences.PUNCTUATION}', ' ', 'g')"
    return f"list_filter(list_transform(string_split({value}, chr(10)), lambda l: trim(l)), lambda l: l <> '')"


def licence_scan() -> str:
    whole = "md5(coalesce(array_to_string(lines, ' '), ''))"

    def known(entries):
        values = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in entries)
        return (f"SELECT {whole} AS digest, min(licence) AS licence FROM (SELECT licence, {_canonical_lines('t')} AS lines "
                f"FROM (VALUES {values}) k(licence, t)) GROUP BY 1")
    return f"""
WITH known_texts AS ({known(TEXTS)}), known_notices AS ({known(NOTICES)}),
canonical AS (SELECT doc_id, {_canonical_lines('text')} AS lines FROM documents),
named AS (SELECT doc_id, list_sort(list(DISTINCT k.licence)) AS notices
          FROM (SELECT doc_id, md5(unnest(lines)) AS digest FROM canonical) l JOIN known_notices k USING (digest) GROUP BY doc_id)
SELECT c.doc_id, {whole} AS digest, t.licence, coalesce(array_to_string(n.notices, ','), '') AS notices
FROM canonical c LEFT JOIN known_texts t ON {whole} = t.digest LEFT JOIN named n USING (doc_id)"""


def chat_conversations() -> str:
    marks = f"regexp_extract(v, '{chats.MARKS}')"

    def items(level: str) -> str:
        joined = f"array_to_string(list_transform(lines, lambda x: CASE WHEN x.level = {level} THEN x.body ELSE '' END), chr(10))"
        normal = lambda x: f"trim(regexp_replace(lower({x}), '[ \\t\\n]+', ' ', 'g'))"
        of = lambda p: f"list_distinct(list_transform(string_split_regex({joined}, '{p}'), lambda y: {normal('y')}))"
        blocks, every = of(r"\n[ \t]*\n"), of(r"\n")
        parts = [(f"list_filter({blocks}, lambda y: y <> '')", chats.PASSAGE, "''"),
                 (f"list_filter({every}, lambda y: y <> '' AND NOT list_contains({blocks}, y))", chats.LINE, "''"),
                 (f"list_filter([{normal(joined)}], lambda y: y <> '')", chats.ALL, "chr(10)")]
        return " || ".join(f"list_transform({texts}, lambda y: {{'hash': md5({mark} || y), 'chars': length(y), 'kind': {kind}}})"
                           for texts, kind, mark in parts)

    kept = (f"lines[i].level = 0 AND NOT (coalesce(lines[i + 1].level, 0) > 0 "
            f"AND regexp_matches(lines[i].body, '{chats.INTRODUCTION}'))")
    said = f"list_transform(list_filter(range(1, len(lines) + 1), lambda i: {kept}), lambda i: lines[i].body)"
    opening, after_role, closing = (x.replace("\n", "' || chr(10) || '") for x in chats.TEMPLATE)
    return f"""
WITH RECURSIVE parsed AS (
  SELECT conv_id, turn, role, list_transform(string_split_regex(coalesce(text, ''), '\\r?\\n'), lambda v: {{
    'level': length(regexp_replace({marks}, '[^>]', '', 'g')), 'body': substr(v, length({marks}) + 1)}}) AS lines
  FROM conversations),
origins AS (SELECT conv_id, item.hash AS hash, min(turn) AS origin, min(turn) = max(turn) AS alone FROM (
  SELECT conv_id, turn, unnest({items('0')}) AS item FROM parsed) GROUP BY 1, 2),
quoted AS (SELECT conv_id, turn, level, unnest({items('level')}, recursive := true) FROM (
  SELECT conv_id, turn, lines, unnest(list_distinct(list_filter(list_transform(lines, lambda x: x.level), lambda l: l > 0))) AS level
  FROM parsed)),
votes AS (SELECT conv_id, turn, level, origin, max(kind = {chats.ALL}) AS in_full, sum(chars) AS chars,
            sum(CASE WHEN alone AND kind >= {chats.PASSAGE} THEN chars ELSE 0 END) AS own
          FROM quoted JOIN origins USING (conv_id, hash) WHERE origin < turn GROUP BY 1, 2, 3, 4),
links AS (SELECT conv_id, turn, origin AS parent_turn FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, in_full DESC, own DESC, chars DESC, origin DESC) AS n
  FROM votes) WHERE n = 1),
climb AS (SELECT conv_id, turn, parent_turn, parent_turn AS root FROM links
          UNION ALL SELECT c.conv_id, c.turn, c.parent_turn, l.parent_turn FROM climb c
          JOIN links l ON l.conv_id = c.conv_id AND l.turn = c.root),
threads AS (SELECT conv_id, turn, min(parent_turn) AS parent_turn, min(root) AS thread_turn FROM climb GROUP BY ALL)
SELECT p.conv_id, p.turn, p.role, t.parent_turn, coalesce(t.thread_turn, p.turn) AS thread_turn,
       list_max(list_transform(lines, lambda x: x.level)) AS quote_levels,
       '{opening}' || coalesce(role, 'unknown') || '{after_role}'
       || regexp_replace(coalesce(array_to_string({said}, chr(10)), ''), '^\\s+|\\s+\\z', '', 'g') || '{closing}' AS message
FROM parsed p LEFT JOIN threads t ON t.conv_id = p.conv_id AND t.turn = p.turn"""


def _crc32(text: str) -> str:
    """crc32 of ASCII text, bit by bit; 3988292384 is its polynomial, reversed."""
    bits = "list_prepend(xor(acc, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0])"
    step = f"list_reduce({bits}, lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::UBIGINT)"
    return f"(4294967295 - list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda acc, b: {step}))"


def _row_digest(text: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


def dataset_manifest(width: int = 16, levels: int = 5) -> str:
    """Trees of ``levels`` levels inside a source, and as many over the sources: enough for width^levels rows of a source."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"""leaves AS (SELECT doc_id, coalesce({_crc32("doc_id::VARCHAR")} % 5 = 0, false) AS tampered,
  {_row_digest("text")} AS leaf, {_row_digest(lower)} AS other, coalesce('s' || source, '') AS grp FROM documents),
placed AS (SELECT *, dense_rank() OVER (ORDER BY encode(grp)) - 1 AS tree,
  row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves),
in_0 AS (SELECT tree, idx, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM placed)"""]

    def climb(name: str) -> str:
        for k in range(levels):
            members = "list(digest ORDER BY idx)"
            parts.append(f"""{name}_{k + 1} AS (SELECT tree, idx // {width} AS idx, {members} AS family,
  CASE WHEN any_value(n) > 1 THEN sha256(array_to_string({members}, '')) ELSE any_value(digest) END AS digest,
  (any_value(n) + {width - 1}) // {width} AS n FROM {name}_{k} GROUP BY 1, 2)""")
        return f"{name}_{levels}"

    tops = climb("in")
    parts.append(f"over_0 AS (SELECT 0 AS tree, tree AS idx, digest, count(*) OVER () AS n FROM {tops})")
    root = climb("over")
    parts.append(f"""path_0 AS (SELECT p.*, t.digest AS subroot, r.digest AS root, CASE WHEN tampered THEN other ELSE leaf END AS node,
  '' AS proof, p.idx AS place, p.tree AS grove FROM placed p JOIN {tops} t ON t.tree = p.tree CROSS JOIN {root} r)""")
    step = 0
    for name in ("in", "over"):
        if name == "over":
            parts.append(f"path_{step + 1} AS (SELECT * REPLACE (tree AS place, 0 AS grove) FROM path_{step})")
            step += 1
        for k in range(levels):
            # a family of one in a tree that has one node left is no step
            left, right = f"family[:place % {width}]", f"family[place % {width} + 2:]"
            text = lambda x: f"array_to_string({x}, '')"
            parts.append(f"""path_{step + 1} AS (SELECT p.* REPLACE (
  CASE WHEN b.n > 1 THEN sha256({text(left)} || node || {text(right)}) ELSE node END AS node,
  CASE WHEN b.n > 1 THEN proof || {text(left)} || {text(right)} ELSE proof END AS proof, place // {width} AS place)
  FROM path_{step} p JOIN {name}_{k + 1} f ON f.tree = p.grove AND f.idx = p.place // {width}
  JOIN (SELECT tree, any_value(n) AS n FROM {name}_{k} GROUP BY 1) b ON b.tree = p.grove)""")
            step += 1
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified FROM path_{step}"""
