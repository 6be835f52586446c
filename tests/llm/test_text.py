"""Chat formatting and SentencePiece encoding: exact round trips."""

import hashlib
import random
from itertools import groupby

import pytest

from cases import ROWS, documents, key
from conftest import SF01
from gpsweave.llm import chat_format as chat
from gpsweave.llm import chat_template as ct
from gpsweave.llm.piece_fst import _SEGMENT, Transducer, compile_model, decode_ids, encode_documents, normalise
from gpsweave.llm.queries import PIECE_MODEL, op6_chat_format

HOSTILE = ["", "\\", "\\\\", "### ", "###", "####", "</turn>", "</turn>\n", "\\### Assistant: </turn> ok", "a: b\n", "</turn", "\\</turn>\n### x: y</turn>\n", "é🎉", "\\n"]


def test_every_hostile_text_reads_back():
    for role in ["user", "assistant", "", "a: b", "x\n", "### r", "\\:", "</turn>"]:
        for text in HOSTILE:
            formatted, spans = chat.render([{"role": role, "text": text}])
            assert chat.read_turn(formatted) == (role, text)
            learned = "".join(chat.unescape(formatted[a:b]) for a, b in spans)
            assert learned == (text if role == "assistant" else "")


def test_random_texts_read_back():
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice(["\\", "#", "###", "</turn>", "\n", " ", ":", "<", "a", "Assistant"]) for _ in range(rng.randint(0, 12)))
        turns = [{"role": "assistant", "text": text}, {"role": "user", "text": text}]
        formatted, spans = chat.render(turns)
        assert chat.read_turn(chat.render(turns[:1])[0]) == ("assistant", text)
        assert "".join(chat.unescape(formatted[a:b]) for a, b in spans) == text


def brute_digest(rows):
    out = []
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
    for c, g in groupby(order, key=lambda r: r[0]):
        g = list(g)
        learned = "".join(t or "" for _, _, r, t in g if r == "assistant")
        formatted = "".join(chat.render([{"role": r or "", "text": t or ""}])[0] for _, _, r, t in g)
        out.append((c, len(g), hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in g).encode()).hexdigest(),
                    len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(formatted)))
    return sorted(out, key=key)


def test_conversation_cases(spark):
    rows = [(i, j, role, text) for i, text in enumerate(HOSTILE) for j, role in enumerate(["system", "user", "assistant"])]
    rows += [(50, 1, "assistant", "same turn b"), (50, 1, "assistant", "same turn a"), (50, None, None, None), (50, 0, "user", None),
             (None, 0, "user", "no id"), (None, 1, "assistant", "no id"), (51, 0, "assistant", "x" * 200_000)]
    rows += [(60, j, "assistant" if j % 2 else "user", f"turn {j}") for j in range(3000)]            # one conversation holds most rows
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS n_turns", "1 AS formatted").repartition(5)
    assert sorted((tuple(r) for r in chat.conversation_digests(df).collect()), key=key) == brute_digest(rows)
    assert chat.conversation_digests(df.limit(0)).count() == 0
    turns = {(r.conv_id, r.turn): r for r in chat.format_turns(df.filter("conv_id = 60")).collect()}
    assert chat.read_turn(turns[60, 7].formatted) == ("assistant", "turn 7")
    assert [turns[60, 7].formatted[s.start:s.end] for s in turns[60, 7].loss_spans] == ["turn 7"]


def test_query_formats_the_hostile_conversation(spark):
    got = {r.conv_id: r for r in op6_chat_format(spark, SF01).collect()}
    text = r"\### Assistant: </turn> ok"
    assert got[-7].n_turns == 2 and got[-7].loss_chars == len(text)
    assert got[-7].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for c, r in got.items() if c != -7), key=key) == brute_digest(rows)


def test_template_language():
    run = lambda source, **env: "".join(p for p, _ in ct.compile_template(source, chat.FILTERS)(env))
    assert run("{% for x in rows %}{{ x.a | upper }};{% endfor %}", rows=[{"a": "p"}, {"a": None}]) == "P;;"
    assert run("{% if v == 'a' %}1{% elif v == 'b' or v == 'c' %}2{% else %}3{% endif %}", v="c") == "2"
    assert run("{% if not v == 'a' and (v != 'b') %}y{% endif %}", v="c") == "y"
    assert run("{{ 'a' ~ v ~ 'b' ~ 'c' }}", v="-") == "a-bc"
    body = ct.fold_constants(ct.parse_template("x{{ 'a' ~ 'b' | upper }}{% if 'q' == 'q' %}c{% else %}{{ v }}{% endif %}d{% if false %}{{ v }}{% endif %}", chat.FILTERS))
    assert body == [("text", "xaBcd")]
    pieces = list(ct.compile_template("a{% generation %}b{% endgeneration %}c", chat.FILTERS)({}))
    assert pieces == [("a", False), ("b", True), ("c", False)]


@pytest.mark.parametrize("source", ["{{ x.__class__ }}", "{{ x.y.z }}", "{{ f() }}", "{{ x[0] }}", "{% for x in y %}", "{% endif %}", "{{ 1 + 1 }}",
                                    "{{ x | nofilter }}", "{% import os %}", "{{ 'a }}", "{% for x in y.z %}{% endfor %}", "{{ }}"])
def test_template_sandbox(source):
    with pytest.raises(ct.TemplateError):
        list(ct.compile_template(source, chat.FILTERS)({"x": {"y": "1"}, "y": []}))


@pytest.fixture(scope="module")
def model(spark):
    return compile_model(spark, PIECE_MODEL)


def test_encoding_equals_the_library_on_documents(spark, model):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").limit(200)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = encode_documents(docs, PIECE_MODEL).collect()
    assert len(got) == 200 and all(r.round_trip for r in got)
    assert all(list(r.token_ids) == lib.encode(texts[r.doc_id]) for r in got)


def test_random_words_equal_the_library(model):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    fst, rng = Transducer(model), random.Random(1)
    for _ in range(1500):
        t = "".join(rng.choice("abcdeinorst   .,AB\n日é🎉") for _ in range(rng.randint(1, 60)))
        ids = fst.encode(_SEGMENT.findall(normalise(t)))[0].tolist()
        assert ids == lib.encode(t) and decode_ids(model, ids) == t


def test_shortest_path_of_a_unigram_model(model):
    """Without the pair acceptor the path of least total cost is taken."""
    pieces = {"\u2581": 3.0, "a": 3.0, "b": 3.0, "ab": 4.0, "ba": 3.5, "\u2581a": 3.2, "aba": 9.9}
    m = {**model, "merges": False, "id": {p: i for i, p in enumerate(pieces)}, "text": dict(enumerate(pieces)),
         "cost": {i: c for i, c in enumerate(pieces.values())}, "longest": 3, "decode": [p.encode() for p in pieces]}
    fst = Transducer(m)

    def best(word):
        cost = [0.0] + [1e18] * len(word)
        for e in range(1, len(word) + 1):
            for s in range(e):
                if word[s:e] in pieces:
                    cost[e] = min(cost[e], cost[s] + pieces[word[s:e]])
        return cost[-1]
    rng = random.Random(3)
    words = ["\u2581" + "".join(rng.choice("ab") for _ in range(rng.randint(0, 9))) for _ in range(200)]
    ids, sizes = fst.encode(words)
    at = 0
    for w, n in zip(words, sizes.tolist()):
        own = [m["text"][i] for i in ids[at:at + n].tolist()]
        at += n
        assert "".join(own) == w and abs(sum(pieces[p] for p in own) - best(w)) < 1e-9


def test_encoding_cases(spark):
    got = sorted(((r.doc_id, r.round_trip, r.decoded) for r in encode_documents(documents(spark), PIECE_MODEL, keep_text=True).collect()), key=key)
    assert got == sorted(((d, True, t or "") for d, t in ROWS), key=key)
    assert encode_documents(documents(spark).limit(0), PIECE_MODEL).count() == 0
