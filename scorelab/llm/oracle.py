"""SQL twins of those operator queries that SQL can express."""

from __future__ import annotations

WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, coalesce({WORDS}, []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
i AS (SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
patterns AS (SELECT DISTINCT item, n, array_to_string(w[s : s + n - 1], ' ') AS p FROM (SELECT *, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS s FROM i)),
windows AS (SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS p
            FROM (SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS s FROM d, (SELECT DISTINCT n FROM i) WHERE len(w) >= n)),
found AS (SELECT doc_id, s, n, item FROM windows JOIN patterns USING (n, p)),
hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM found) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

LINE_DEDUP = """
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents),
k AS (SELECT *, trim(replace(replace(line, chr(9), ' '), chr(13), ' ')) AS key FROM l),
bad AS (SELECT key, min(doc_id) AS first FROM k WHERE key <> '' GROUP BY 1 HAVING count(DISTINCT source) >= 10),
kept AS (SELECT k.doc_id, string_agg(line, chr(10) ORDER BY place) AS text FROM k LEFT JOIN bad USING (key) WHERE bad.key IS NULL OR bad.first = k.doc_id GROUP BY 1)
SELECT d.doc_id, CAST(len(string_split(coalesce(d.text, ''), chr(10))) AS BIGINT) AS n_lines,
       CAST(CASE WHEN coalesce(kept.text, '') = '' THEN 0 ELSE len(string_split(kept.text, chr(10))) END AS BIGINT) AS n_left,
       sha256(coalesce(kept.text, '')) AS text_sha256
FROM documents d LEFT JOIN kept USING (doc_id)"""


def _draw(name: str, weight: float) -> str:
    return f"-ln((CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '/' || '{name}'), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0) / {weight}"


def _least(names: list[str], weights: list[float], values: list[str]) -> str:
    """The value whose draw is smallest."""
    draws = [_draw(n, w) for n, w in zip(names, weights)]
    cases = " ".join(f"WHEN {d} = least({', '.join(draws)}) THEN {v}" for d, v in zip(draws, values))
    return f"CASE {cases} END"


def _racks(region: int) -> str:
    racks = [2 * region, 2 * region + 1]
    shards = [_least([f"/region{region}/rack{r}/{s}" for s in (2 * r, 2 * r + 1)], [1.0, 1.0], [str(2 * r), str(2 * r + 1)]) for r in racks]
    return _least([f"/region{region}/rack{r}" for r in racks], [2.0, 2.0], shards)


_BYTES = "list_transform(range(CAST(strlen(text) AS BIGINT)), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))"
SHARDING = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
t AS (SELECT list(c ORDER BY n) AS crc FROM (SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(n))),
sums AS (SELECT doc_id, strlen(text) + 1 AS size, xor(list_reduce(list_prepend(4294967295, {_BYTES}), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32 FROM d, t)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law,
  {_least(['/region0', '/region1'], [4.0, 4.0], [_racks(0), _racks(1)])} AS shard,
  {_least(['/region0', '/region1', '/region8'], [4.0, 4.0, 1.0], [_racks(0), _racks(1), '8'])} AS grown_shard FROM sums"""


_ID_BYTES = "list_transform(range(CAST(strlen(id) AS BIGINT)), lambda i: CAST(unicode(substr(id, CAST(i + 1 AS BIGINT), 1)) AS BIGINT))"


def _field(column: str) -> str:
    return f"coalesce(CAST(strlen(CAST({column} AS VARCHAR)) AS VARCHAR) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


MERKLE = f"""
WITH RECURSIVE crcs AS (SELECT list(c ORDER BY n) AS crc FROM (SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(n))),
d AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') AS id, {_leaf("n_chars")} AS leaf, {_leaf("(n_chars + 1)")} AS changed FROM documents),
e AS (SELECT *, coalesce(xor(list_reduce(list_prepend(4294967295, {_ID_BYTES}), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295), 0) AS sum FROM d, crcs),
p AS (SELECT row_number() OVER () AS row, doc_id, lang, leaf, CASE WHEN sum % 7 = 0 THEN changed ELSE leaf END AS shown,
             row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM e),
t(lang, lvl, pos, h, n) AS (SELECT lang, 0, pos, leaf, n FROM p
  UNION ALL SELECT lang, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), max((n + 1) // 2) FROM t WHERE n > 1 GROUP BY lang, lvl, pos // 2),
s AS (SELECT lang, h AS subroot, lvl AS top, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u(lvl, pos, h, n) AS (SELECT 0, pos, subroot, n FROM s
  UNION ALL SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), max((n + 1) // 2) FROM u WHERE n > 1 GROUP BY lvl, pos // 2),
steps AS (SELECT lang, top AS height, s.pos AS start, (SELECT max(lvl) FROM u) AS above FROM s),
places AS (SELECT p.row, p.lang, lvl, CASE WHEN lvl < height THEN p.pos >> lvl ELSE start >> (lvl - height) END AS place, lvl >= height AS up
           FROM p JOIN steps ON p.lang IS NOT DISTINCT FROM steps.lang, LATERAL (SELECT unnest(range(height + above)) AS lvl)),
nodes AS (SELECT lang, lvl, pos, h, false AS up FROM t UNION ALL SELECT s.lang, top + u.lvl, u.pos, u.h, true FROM s, u),
siblings AS (SELECT row, places.lvl AS lvl, place, nodes.h FROM places LEFT JOIN nodes ON places.lang IS NOT DISTINCT FROM nodes.lang AND places.lvl = nodes.lvl AND places.up = nodes.up AND nodes.pos = xor(place, 1)),
proof AS (SELECT row, sha256(coalesce(string_agg(h, '' ORDER BY lvl), '')) AS proof_sha256 FROM siblings GROUP BY row),
f(row, lvl, h) AS (SELECT row, 0, shown FROM p
  UNION ALL SELECT f.row, f.lvl + 1, sha256(CASE WHEN g.h IS NULL THEN f.h WHEN g.place % 2 = 1 THEN g.h || f.h ELSE f.h || g.h END) FROM f JOIN siblings g ON f.row = g.row AND f.lvl = g.lvl),
last AS (SELECT row, arg_max(h, lvl) AS folded_root FROM f GROUP BY row),
r AS (SELECT h AS root FROM u WHERE n = 1)
SELECT p.doc_id, p.leaf, s.subroot, r.root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang, r, last LEFT JOIN proof ON last.row = proof.row WHERE last.row = p.row"""
