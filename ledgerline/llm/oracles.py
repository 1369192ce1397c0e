"""DuckDB SQL for the contract queries that SQL can express."""

from __future__ import annotations

from ledgerline.llm.chat_tree import CONTROL, END, ESCAPE, START, TRAINED
from ledgerline.llm import fill_middle as fim, sketch_dedup as near, vector_codes as vec
from ledgerline.llm.decontaminate import WINDOW

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(table: str, key: str) -> str:
    return (f"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
            rf"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table}")


OP4 = """
SELECT page_id, strlen(payload) AS payload_bytes,
       translate(concat(to_base(('0x' || h[1:10])::BIGINT, 32, 8), to_base(('0x' || h[11:20])::BIGINT, 32, 8),
                        to_base(('0x' || h[21:30])::BIGINT, 32, 8), to_base(('0x' || h[31:40])::BIGINT, 32, 8)),
                 '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h,
             max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keep FROM pages) t"""


def _found(text: str, needle: str) -> str:
    return f"(length({text}) - length(replace({text}, '{needle}', ''))) // {len(needle)}"


def _escaped(text: str) -> str:
    """Code points of a text once escaped: two more for every control string,
    one more for every escape character."""
    return " + ".join([f"length({text})", _found(text, ESCAPE), *(f"2 * ({_found(text, c)})" for c in CONTROL)])


OP6 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = '{TRAINED}' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = '{TRAINED}' THEN text ELSE '' END, '' ORDER BY turn, role, text))
         AS loss_sha256,
       CAST(sum({len(START) + len(END) + 2} + {_escaped("role")} + {_escaped("text")}
                + length(role) - length(replace(role, chr(10), ''))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""

OP9 = f"""
WITH d AS ({_words("documents", "doc_id")}),
b AS (SELECT item_id, w, least({WINDOW}, len(w)) AS n FROM ({_words("benchmark", "item_id")}) t WHERE len(w) > 0),
item_windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
                 FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM b) t),
doc_windows AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
                FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i
                      FROM d JOIN (SELECT DISTINCT n FROM b) s ON len(w) >= n) t),
hits AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, g)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
              FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) t GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) t GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

_GRAM = " || ' ' || ".join(f"w[i + {k}]" for k in range(near.SHINGLE))
OP11 = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {near.SHINGLE}
           THEN list_transform(range(1, len(w) - {near.SHINGLE - 2}), lambda i: {_GRAM})
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM t),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
           FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
          WHERE {near.THRESHOLD[1]} * shared.n >= {near.THRESHOLD[0]} * (p.n + q.n - shared.n)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT t.doc_id, coalesce(sizes.n, 0) AS n_shingles, component_id, t.doc_id = component_id AS kept
FROM t JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r ON r.doc_id = t.doc_id
LEFT JOIN sizes ON sizes.doc_id = t.doc_id"""


def _vector_codes() -> str:
    """Rounds of assignment and update, one after the other. Squared distances
    are worked out as doubles; all terms are integers far below 2^53."""
    dims = f"len(v) // {vec.PARTS}"
    steps = []
    for k in range(vec.ROUNDS + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (
  SELECT r, p, min(struct_pack(d := d, e := e)) AS best FROM (
    SELECT r, p, e, (x.xx - 2 * list_dot_product(x.x, b.x) + list_dot_product(b.x, b.x))::BIGINT AS d
    FROM parts x JOIN book{k} b USING (p)) t GROUP BY r, p)""")
        if k < vec.ROUNDS:
            steps.append(f"""
sums{k} AS (
  SELECT p, e, i, sum(c) AS s, count(*) AS n
  FROM (SELECT p, best.e AS e, unnest(x)::HUGEINT AS c, unnest(range(len(x))) AS i
        FROM near{k} JOIN parts USING (r, p)) t GROUP BY p, e, i),
book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN (
    SELECT p, e, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS x FROM sums{k} GROUP BY p, e) m
  ON m.p = b.p AND m.e = b.e)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, v) AS r, * FROM (
    SELECT vec_id, label, list_transform(embedding, lambda c: floor(c::DOUBLE * {vec.SCALE})) AS v FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0) t),
parts AS MATERIALIZED (
  SELECT r, p, x, list_dot_product(x, x) AS xx FROM (
    SELECT r, p, v[p * {dims} + 1:(p + 1) * {dims}] AS x FROM kept, range({vec.PARTS}) g(p)) t),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM parts WHERE r <= {vec.ENTRIES}),{",".join(steps)},
digest AS (SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS h FROM (
  SELECT p, e, unnest(x) AS c, unnest(range(len(x))) AS i FROM book{vec.ROUNDS}) t),
coded AS (
  SELECT r, string_agg(format('{{:02x}}', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
  FROM near{vec.ROUNDS} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       h AS codebooks_sha256
FROM kept JOIN coded USING (r), digest"""


OP12 = _vector_codes()

_P, _S, _M = (x.decode() for x in (fim.PREFIX, fim.SUFFIX, fim.MIDDLE))
OP13 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         sha256('{fim.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
draws AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS h1, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS h2,
         ('0x' || h[17:24])::BIGINT % 100 AS h3, ('0x' || h[25:32])::BIGINT % 100 AS h4 FROM d),
cuts AS (
  SELECT doc_id, text, CAST(n AS BIGINT) AS n,
         CASE WHEN text = '' OR contains(text, '{_P}') OR contains(text, '{_S}') OR contains(text, '{_M}')
                OR h3 >= {fim.FIM_PERCENT} THEN 'plain' WHEN h4 < {fim.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form,
         coalesce(array_to_string(u[1:least(h1, h2)], ''), '') AS p,
         coalesce(array_to_string(u[least(h1, h2) + 1:greatest(h1, h2)], ''), '') AS m,
         coalesce(array_to_string(u[greatest(h1, h2) + 1:], ''), '') AS s FROM draws)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{_P}' || p || '{_S}' || s || '{_M}' || m
              ELSE '{_S}' || s || '{_P}' || p || '{_M}' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cuts"""

SQL = {"op4_warc": OP4, "op6_chat_tree": OP6, "op9_decontaminate": OP9, "op11_sketch_dedup": OP11,
       "op12_vector_codes": OP12, "op13_fill_middle": OP13}
