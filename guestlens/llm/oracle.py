"""DuckDB SQL for the queries of this subpackage that SQL can express, without signatures, filters or hashes."""

from __future__ import annotations

_SPLIT = r"'[\x20\x09-\x0D]+'"
_ASCII = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, {_SPLIT}), lambda w: w <> '')"


def shingles(ws: str, size: int) -> str:
    """Consecutive words; a shorter sequence is one shingle, an empty one none."""
    return f"""CASE WHEN len({ws}) >= {size} THEN list_transform(range(1, len({ws}) - {size - 2}), lambda i: array_to_string({ws}[i:i + {size - 1}], ' '))
  WHEN len({ws}) > 0 THEN [array_to_string({ws}, ' ')] ELSE [] END"""


def contaminated(size: int, percent: int) -> str:
    return f"""WITH d AS (SELECT doc_id, {words("lower(coalesce(text, ''))")} AS ws FROM documents),
i AS (SELECT item_id, {words("lower(coalesce(text, ''))")} AS ws FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest({shingles("ws", size)}) AS s FROM d),
qs AS (SELECT DISTINCT item_id, unnest({shingles("ws", size)}) AS s FROM i),
n AS (SELECT item_id, count(*) AS n_item FROM qs GROUP BY 1)
SELECT doc_id, item_id, n_item, count(*) AS n_shared FROM ds JOIN qs USING (s) JOIN n USING (item_id)
GROUP BY ALL HAVING count(*) * 100 >= n_item * {percent}"""


def near_duplicates(size: int, percent: int) -> str:
    return f"""WITH RECURSIVE d AS (SELECT doc_id, {words(_ASCII)} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest({shingles("ws", size)}) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= {percent} * (x.n + y.n - common)),
r(id, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.seen FROM r JOIN e ON e.a = r.id),
c AS (SELECT id, min(seen) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN c ON c.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""


def similar_lines(percent: int) -> str:
    """Lines as sets of words, the k-th use of a word a token of its own.

    Two sets of the wanted similarity share one of the rarest n - ceil(percent n / 100) + 1 tokens of each; pairs that do are compared whole.
    """
    return f"""WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS line_no FROM t),
w AS (SELECT doc_id, line_no, doc_id::HUGEINT * 1000000000 + line_no AS place, unnest({words("lower(line)")}) AS word FROM l),
k AS (SELECT doc_id, line_no, place, word || ' ' || row_number() OVER (PARTITION BY place, word) AS s FROM w),
s AS (SELECT doc_id, line_no, place, list_sort(list(s)) AS own FROM k GROUP BY ALL),
c AS (SELECT own, min(place) AS place, len(own) AS n, row_number() OVER () AS c FROM s GROUP BY own),
u AS (SELECT c, place, n, unnest(own) AS s FROM c),
df AS (SELECT s, count(*) AS df FROM u GROUP BY s),
p AS (SELECT c, place, n, s FROM u JOIN df USING (s) QUALIFY row_number() OVER (PARTITION BY c ORDER BY df, s) <= n - ({percent} * n + 99) // 100 + 1),
q AS (SELECT DISTINCT x.c AS c, y.c AS d FROM p x JOIN p y USING (s) WHERE y.place < x.place AND 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)),
m AS (SELECT q.c, x.n + y.n AS n, len(list_intersect(x.own, y.own)) AS common FROM q JOIN c x ON x.c = q.c JOIN c y ON y.c = q.d),
f AS (SELECT DISTINCT c FROM m WHERE 100 * common >= {percent} * (n - common)),
r AS (SELECT l.doc_id, l.line_no, coalesce(c.place < s.place OR f.c IS NOT NULL, false) AS removed FROM l LEFT JOIN s ON s.doc_id = l.doc_id AND s.line_no = l.line_no
  LEFT JOIN c ON c.own = s.own LEFT JOIN f ON f.c = c.c)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE removed) AS n_removed,
       coalesce(list(line_no::INTEGER ORDER BY line_no) FILTER (WHERE removed), []) AS removed_lines FROM r GROUP BY doc_id"""


def compacted_spans(window: int) -> str:
    return f"""WITH d AS (SELECT doc_id, {words("coalesce(text, '')")} AS ws FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ws) - {window - 2})) AS i, unnest(list_transform(range(1, len(ws) - {window - 2}),
  lambda i: array_to_string(ws[i:i + {window - 1}], ' '))) AS s FROM d WHERE len(ws) >= {window}),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + {window})) AS i FROM w JOIN f USING (s) WHERE first < doc_id),
t AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d),
k AS (SELECT t.doc_id, count(g.i) AS n_removed, string_agg(word, ' ' ORDER BY t.i) FILTER (WHERE g.i IS NULL) AS kept
  FROM t LEFT JOIN g ON g.doc_id = t.doc_id AND g.i = t.i GROUP BY t.doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id"""


def crc32(word: str) -> str:
    """The unsigned CRC of a string's UTF-8 bytes, by the polynomial's table; needs a column ``steps`` made by ``CRC_STEPS``."""
    code = f"hex(encode({word}))"
    bytes_ = f"list_transform(range(0, len({code}) // 2), lambda i: ('0x' || substr({code}, (2 * i + 1)::INT, 2))::BIGINT)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {bytes_}), lambda a, b: xor(a >> 8, steps[(xor(a, b) & 255) + 1])))"


CRC_STEPS = """SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
  lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS steps"""


def importance_ranks(buckets: int, least: int, percent: int, seed: int) -> str:
    """Features are single words."""
    parts = r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    ws = f"list_filter(regexp_split_to_array({_ASCII}, {parts}), lambda w: w <> '')"
    return f"""WITH d AS (SELECT doc_id, {ws} AS ws FROM documents),
dw AS (SELECT doc_id, unnest(ws) AS w FROM d),
bw AS (SELECT unnest({ws}) AS w FROM benchmark),
steps AS ({CRC_STEPS}),
v AS (SELECT w, {crc32("w")} % {buckets} AS bucket FROM (SELECT w FROM dw UNION SELECT w FROM bw), steps),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN v USING (w) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN v USING (w) GROUP BY 1),
n AS (SELECT (SELECT count(*) FROM dw)::DOUBLE + {buckets} AS s_all, (SELECT count(*) FROM bw)::DOUBLE + {buckets} AS t_all),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * s_all / ((coalesce(s, 0)::DOUBLE + 1) * t_all)))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket), n),
x AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM dw JOIN v USING (w) JOIN g USING (bucket) GROUP BY 1),
h AS (SELECT doc_id, len(ws) AS n_features, coalesce(weight, 0) AS weight,
  ('0x' || substr(sha256('{seed}:' || doc_id), 1, 8))::BIGINT AS h FROM d LEFT JOIN x USING (doc_id)),
r AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score, n_features >= {least} AS fit FROM h),
p AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS place, count(*) FILTER (WHERE fit) OVER () AS fits FROM r)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN fit AND place <= {percent} * fits // 100 THEN place END AS rank FROM p"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_containment_search": contaminated(5, 80),
        "op2_minhash_bayes": near_duplicates(3, 85),
        "op4_similar_lines": similar_lines(80),
        "op10_compacted_spans": compacted_spans(13),
        "op13_importance_resampling": importance_ranks(10_000, 20, 10, 2024),
    }
