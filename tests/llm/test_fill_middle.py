from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings, strategies as st

from ledgerline.llm import fill_middle as M

UNITS = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    """The transformation on one whole text: form, prefix, middle, suffix, output."""
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aé日 \n\t\x0b\x1f\x85\xa0<P", max_size=40))
def test_units_and_code_points(text):
    raw = text.encode()
    ends = [0, *M.unit_ends(raw).tolist()]
    assert [raw[a:b].decode() for a, b in zip(ends, ends[1:])] == UNITS.findall(text)
    assert M.n_chars(raw) == len(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="a <SPM>", max_size=30), st.integers(0, 8), st.integers(0, 8), st.integers(1, 4),
       st.integers(1, 5), st.booleans())
def test_output_is_taken_apart_at_any_piece_border(text, x, y, units, step, psm):
    raw = text.encode()
    if not raw or M._MARKER.search(raw):
        return
    ends = M.unit_ends(raw)
    first, second = sorted((min(x, len(ends)), min(y, len(ends))))
    form = M.PSM if psm else M.SPM
    out = b"".join(M.pieces(raw, form, ends, first, second, units))
    parts, found = M._Parts(form), {}
    for at in range(0, len(out), step):
        for place, data in parts.feed(out[at:at + step]):
            found[place] = found.get(place, b"") + data
    place, data = parts.rest()
    found[place] = found.get(place, b"") + data
    assert b"".join(found.get(k, b"") for k in range(3)) == raw
    assert sum(out.count(m) for m in (b"<P>", b"<S>", b"<M>")) == 3


def test_documents_equal_the_plain_transformation(spark, docs_of, prose):
    rows = [(i, prose(i, 3 + i % 60), "s") for i in range(120)]
    rows += [(200, None, None), (201, "", "s"), (202, " \n\t", "s"), (203, "a <P> b", "s"), (204, "<S>", "s"),
             (205, "x" * 20_000, "s"), (206, prose(9, 30_000), "s"), (207, "é日 😀 x\x85 y \x1f", "s"),
             (208, "< P><S <M", "s"), (5, "same id, other text", "s"), (5, "same id, other text", "s"),
             (None, prose(3, 50), "s"), (None, "nobody", "s"), (-7, prose(4, 40), "s")]
    docs = docs_of(rows, "n form key seq part data output_sha256")
    want = sorted((i if i is not None else -10 ** 9, *plain(i, t)) for i, t, _ in rows)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assembled = M.assemble(docs, units=16)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -10 ** 9, r["form"], r["text"])
                  for r in M.transform(docs, units=16).collect()) == sorted((w[0], w[2], w[5]) for w in want)
    got = M.digest(M.restore(assembled)).collect()
    assert len(got) == len(rows) and {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -10 ** 9, r["n"], r["form"], r["prefix_chars"] or 0,
                   r["middle_chars"] or 0, r["output_sha256"]) for r in got) == sorted(
        (w[0], w[1], w[2], w[3] or 0, w[4] or 0, sha(w[5])) for w in want)
    assert sorted(r["restored_sha256"] for r in got) == sorted(sha(t or "") for _, t, _ in rows)
    assert all((r["prefix_chars"] is None) == (r["form"] == "plain") for r in got)


def test_one_exchange_and_empty_table(spark, docs_of):
    docs = docs_of([(1, "a b c", "s")])
    plan = M.digest(M.restore(M.assemble(docs)))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("Exchange hashpartitioning(key") == 1
    empty = docs.where("false")
    assert M.digest(M.restore(M.assemble(empty))).count() == 0
