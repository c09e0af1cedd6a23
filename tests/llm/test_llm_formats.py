"""Whitening, fill-in-middle and chat formatting against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_frames import awkward, documents

from conftest import SF_SMALL
from tollgate.llm import chat_template as C
from tollgate.llm import fill_middle as M
from tollgate.llm import queries
from tollgate.llm import whitening as W
from tollgate.llm.common import byte_slices, read


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- whitening -----------------------------------------------------------------------
def vectors(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, key string, x long, copies string"
    return spark.createDataFrame([(v, e, 0, "k", 1, "c") for v, e in rows], schema)


def plain_whitening(rows, components=32, weights="count"):
    """(x by row, n, sums, covariance) straight from the contract."""
    x = [tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in e) for _, e in rows]
    fit = x if weights == "count" else sorted(set(x))
    a = np.array(fit, dtype=object)
    n, sums = len(fit), a.sum(0)
    centred = (a - sums / n).astype(float)
    return x, n, sums, centred.T @ centred / n


def check_whitening(out, rows, components=32, weights="count"):
    x, n, sums, cov = plain_whitening(rows, components, weights)
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1][:components], vecs[:, ::-1][:, :components]
    got = {}
    for r in out:
        got.setdefault((r.vec_id), []).append(r)
    assert {r.n for r in out} == {n} and max(r.identity_error for r in out) < 1e-8 and len({r.identity_error for r in out}) == 1
    signs = {}
    for (vec_id, _), xs in zip(rows, x):
        mine = sorted(got[vec_id], key=lambda r: r.component)
        assert [r.component for r in mine] == list(range(1, len(mine) + 1))
        assert all(int(r.deviation) == sum((n * c - s) ** 2 for c, s in zip(xs, sums)) for r in mine)
        z = ((np.array(xs, object) - sums / n).astype(float) @ vecs) / np.sqrt(values)
        for r, want, e in zip(mine, z, values):
            assert r.explained == pytest.approx(e / np.trace(cov), rel=1e-9)
            if abs(want) > 1e-6:
                sign = signs.setdefault(r.component, math.copysign(1, want * r.whitened))
                assert sign * r.whitened == pytest.approx(want, rel=1e-6, abs=1e-8)


def test_whitening_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in read(spark, SF_SMALL, "embeddings").collect()]
    out = queries.op11_whitening(spark, SF_SMALL)
    assert dict(out.dtypes)["deviation"] == "bigint" and dict(out.dtypes)["component"] == "int"
    got = out.collect()
    assert len(got) == 32 * len(rows)
    check_whitening(got, rows)


@pytest.mark.parametrize("weights", ["count", "one"])
def test_whitening_of_copies(spark, weights, monkeypatch):
    monkeypatch.setattr(W, "HOT_SHARE", 10)  # some groups are joined by broadcast, others not
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 6)).astype("float32").tolist()
    rows = [(i, base[0] if i < 60 else base[i % 40]) for i in range(150)]
    out = W.whiten(vectors(spark, rows).repartition(5), components=4, weights=weights).collect()
    assert len(out) == 150 * 4
    if weights == "count":
        check_whitening(out, rows, 4)
    else:
        check_whitening(out, rows, 4, "one")


def test_whitening_leaves_out_unusable_rows(spark):
    rng = np.random.default_rng(6)
    good = [(i, rng.normal(size=3).tolist()) for i in range(20)] + [(3, [0.5, 0.25, -1.0]), (None, [1.0, 2.0, 3.0])]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [float("nan")] * 3), (104, [float("inf"), 0.0, 0.0]),
           (105, [1.0, 2.0]), (106, [1e30, 0.0, 0.0])]
    got = W.whiten(vectors(spark, good + bad)).collect()
    assert sorted({r.vec_id for r in got}, key=str) == sorted({v for v, _ in good}, key=str)
    assert len(got) == 3 * len(good) and {r.n for r in got} == {len(good)}


def test_whitening_without_variance_is_empty(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(1, None)]):
        out = W.whiten(vectors(spark, rows))
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert out.count() == 0
    # One dimension without variance: one component less.
    out = W.whiten(vectors(spark, [(i, [float(i), 1.0]) for i in range(9)])).collect()
    assert {r.component for r in out} == {1} and len(out) == 9


def test_centred_is_exact_beyond_64_bits():
    x = np.array([[2**40, 5], [2**40 + 3, -7]])
    n, sums = 2**30, [2**69, 11]
    exact, _ = W.centred(x, n, sums)
    assert [[int(v) for v in row] for row in exact] == [[n * int(c) - s for c, s in zip(row, sums)] for row in x]
    assert W.squares(exact) == [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    assert W.squares(np.array([[2**40, 1]])) == [2**80 + 1]


# -- fill-in-middle --------------------------------------------------------------------
TEXTS = st.text(alphabet=st.sampled_from("aZ <P>SM\n\t1é߿ࠀ中￿𐀀😀"), max_size=60)


def plain_fim(doc_id, text, percent=90):
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    if not text or any(m in text for m in M.MARKS) or h[2] % 100 >= percent:
        return len(tokens), "plain", None, None, text
    parts = ["".join(p) for p in (tokens[:a], tokens[a:b], tokens[b:])]
    if h[3] % 100 < 20:
        return len(tokens), "spm", len(parts[0]), len(parts[1]), f"<S>{parts[2]}<P>{parts[0]}<M>{parts[1]}"
    return len(tokens), "psm", len(parts[0]), len(parts[1]), f"<P>{parts[0]}<S>{parts[2]}<M>{parts[1]}"


def test_fill_in_middle_equals_brute_force(spark):
    rng = random.Random(4)
    odd = [(1000 + i, "".join(rng.choice("aZ <P>SM\n\t1é߿ࠀ中￿𐀀😀") for _ in range(rng.randrange(40)))) for i in range(400)]
    rows = awkward() + odd + [(2000, "x <P> y"), (2001, "中" * 3000 + "a" * 5000 + "é"), (2002, "<P"), (2003, "<<S<S")]
    got = M.restore(M.fill_in_middle(documents(spark, rows).repartition(3))).collect()
    want = sorted((str((d, *plain_fim(d, t), t or "")) for d, t in rows))
    assert sorted(str((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored)) for r in got) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_over_block_edges(spark, monkeypatch):
    rng = random.Random(8)
    for block in (1, 2, 3, 7):
        monkeypatch.setattr(M, "_BLOCK", block)
        for _ in range(200):
            text = "".join(rng.choice("ab é中😀\n") for _ in range(rng.randrange(30)))
            raw = np.frombuffer(text.encode(), np.uint8)
            tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
            assert M.count_tokens(raw) == len(tokens)
            wanted = [rng.randrange(len(tokens) + 1) for _ in range(3)]
            assert M.byte_cuts(raw, wanted) == [len("".join(tokens[:w]).encode()) for w in wanted]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_exception_index_converts_both_ways(text):
    if any(0xD800 <= ord(c) < 0xE000 for c in text):
        return
    index = M.ExceptionIndex(np.frombuffer(text.encode(), np.uint8))
    assert len(index.at) == sum(ord(c) > 127 for c in text)
    for i in range(len(text) + 1):
        byte = len(text[:i].encode())
        assert index.byte(i) == byte and index.code_points(byte) == i


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.data())
def test_rebuild_inverts_both_orders(text, data):
    if any(m in text for m in M.MARKS):
        return
    a = data.draw(st.integers(0, len(text)))
    b = data.draw(st.integers(a, len(text)))
    p, m, s = text[:a], text[a:b], text[b:]
    marks = tuple(x.encode() for x in M.MARKS)
    assert M.rebuild(f"<P>{p}<S>{s}<M>{m}".encode(), "psm", marks).decode() == text
    assert M.rebuild(f"<S>{s}<P>{p}<M>{m}".encode(), "spm", marks).decode() == text


def test_fill_in_middle_of_no_documents(spark):
    out = M.restore(M.fill_in_middle(documents(spark, [])))
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"] and out.count() == 0


def test_batches_are_cut_by_bytes():
    texts = ["a" * 10, None, "b" * 25, "", "c" * 3, "d" * 30]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(6))], names=["text", "i"])
    parts = list(byte_slices(batch, "text", 20))
    assert [x for p in parts for x in p.column("text").to_pylist()] == texts
    assert [p.num_rows for p in parts] == [2, 1, 2, 1]  # a row above the limit goes alone


# -- chat formatting --------------------------------------------------------------------
def render(source, *messages):
    return "".join(t for t, _ in C.compile_template(source)([{"role": r, "text": t} for r, t in messages]))


def test_templates_render():
    assert render("a{{ 'b' }}{# no #}c") == "abc"
    assert render("{% for m in messages %}{{ loop.index }}:{{ m.role | upper }}={{ m.text }};{% endfor %}", ("u", "x"), ("v", "y")) == "1:U=x;2:V=y;"
    assert render("{% for m in messages %}{% if loop.first %}<{% endif %}{{ m.text }}{% if loop.last %}>{% endif %}{% endfor %}", ("u", "x"), ("u", "y")) == "<xy>"
    assert render("{% set n = 'q' ~ 1 %}{{ n + 'r' }}{% if n == 'q1' and not false %}!{% else %}?{% endif %}") == "q1r!"
    assert render("a \n {%- if true -%} \n b {%- endif %} c") == "ab c"
    assert render("{% if none %}a{% elif 2 > 1 %}b{% else %}c{% endif %}{{ none }}{{ 'x\\n' }}") == "bx\n"
    assert render("{{ ('a' ~ 'b') | length }}") == "2"


def test_constants_are_folded():
    tree = C.fold(C.parse("a{{ 'b' ~ 1 }}{% if 1 == 2 %}no{% elif true %}{{ 'x' | upper }}{% else %}no{% endif %}z"))
    assert tree == (C.Output(C.Const("ab1Xz")),)
    tree = C.fold(C.parse("{% for m in messages %}{% if true and m.role == 'a' ~ 'b' %}{{ 'p' }}q{% endif %}{% endfor %}"))
    test = C.Op("==", (C.Field("m", "role"), C.Const("ab")))
    assert tree == (C.Loop("m", (C.Branch(((test, (C.Output(C.Const("pq")),)),)),)),)


@pytest.mark.parametrize("source", [
    "{{ x }}", "{{ m.role }}", "{{ 'a' | system }}", "{{ 'a'.upper }}", "{{ ''.__class__ }}", "{{ open('x') }}", "{% include 'x' %}",
    "{% for m in messages %}{{ m.__class__ }}{% endfor %}", "{% for m in messages %}{{ m }}{% endfor %}",
    "{% for m in messages %}{% for k in messages %}{% endfor %}{% endfor %}", "{% for i in 9 %}{% endfor %}",
    "{% for m in messages %}{% endfor %}{% for k in messages %}{% endfor %}", "{% if true %}", "{% endif %}", "{{ (1 }}", "{{ 1 2 }}", "{{ }}",
    "{% set loop = 1 %}{% set messages.x = 2 %}", "{{ 'a' | }}", "{{ 1 ; 2 }}",
])
def test_templates_outside_the_language_fail(source):
    with pytest.raises(C.TemplateError):
        C.compile_template(source)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from([*C.CONTROL, "<", "[", "\\", "/", "s>", "INST]", "a", " ", "\n", "é"]), max_size=14).map("".join))
def test_guard_is_reversible_and_leaves_no_control_string(text):
    guarded = C.guard(text)
    assert not any(c in guarded for c in C.CONTROL)
    assert C.unguard(guarded) == text
    if not any(c in text.replace("\\", "") for c in C.CONTROL):
        assert guarded == text


def conversations(spark, rows):
    schema = "conv_id long, turn long, role string, text string, part string, formatted long, loss int"
    return spark.createDataFrame([(*r, "p", 1, 2) for r in rows], schema)


def plain_chat(rows):
    out = {}
    order = lambda v: (v is not None, v if v is not None else 0)
    for conv, turn, role, text in sorted(rows, key=lambda r: (order(r[0]), order(r[1]), (r[2] is not None, r[2] or ""), (r[3] is not None, r[3] or ""))):
        out.setdefault(conv, []).append((role or "", text or ""))
    found = []
    for conv, turns in out.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        formatted = "<s>"
        for r, t in turns:
            g = C.guard(t)
            formatted += f"[INST] {g} [/INST]" if r == "user" else f" {g}</s>" if r == "assistant" else f"[ROLE]{C.guard(r)}[TEXT]{g}[/ROLE]"
        found.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(formatted)))
    return sorted(found, key=str)


def chat_rows():
    rng = random.Random(2)
    bits = [*C.CONTROL, "<\\s>", "[\\\\INST]", "\\", "\n", " ", "a", "é😀", "[ROLE", "]"]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(8)))
    rows = [(i, t, rng.choice(["user", "assistant", "assistant", "system", "[/ROLE]", "a\nb", "", None]), text())
            for i in range(60) for t in range(rng.randrange(1, 7))]
    rows += [(70, None, "user", "no turn"), (70, 1, "user", None), (70, 1, "user", ""), (70, 1, "assistant", "tie"), (70, 1, "assistant", "tie")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "either"), (71, 0, "assistant", "x" * 200_000), (72, 5, None, None)]
    return rows + [(73, t, ("user", "assistant")[t % 2], f"turn {t}") for t in range(3000)]


@pytest.mark.parametrize("size", [1, 50, C.PART_CHARS])
def test_chat_formatting_reads_back(spark, size):
    rows = chat_rows()
    random.Random(1).shuffle(rows)
    parts = C.format_conversations(conversations(spark, rows).repartition(4), part_chars=size)
    want = plain_chat(rows)
    got = C.read_back(parts, in_order=True).collect()
    assert sorted((tuple(r) for r in got), key=str) == want
    stored = spark.createDataFrame(sorted((tuple(r) for r in parts.collect()), key=lambda r: (r[1], str(r[0]))), parts.schema)
    assert sorted((tuple(r) for r in C.read_back(stored.repartition(3)).collect()), key=str) == want


def test_loss_mask_covers_assistant_texts_alone(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u</s>"), (1, 2, "assistant", "a[INST]b"), (1, 3, "assistant", "")]
    (part,) = C.format_conversations(conversations(spark, rows)).collect()
    assert part.formatted == "<s>[ROLE]system[TEXT]s[/ROLE][INST] u<\\/s> [/INST] a[\\INST]b</s> </s>"
    assert [part.formatted[s.start : s.end] for s in part.loss] == ["a[\\INST]b", ""]


def test_no_conversations(spark):
    out = C.read_back(C.format_conversations(conversations(spark, [])))
    assert out.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"] and out.count() == 0


def test_a_wrong_template_fails_before_the_job(spark):
    with pytest.raises(C.TemplateError):
        C.format_conversations(conversations(spark, []), template="{{ nothing }}")
