import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nestdoc.llm import chat as C

TURNS = st.lists(st.tuples(st.text(alphabet="user<[\\|>é", max_size=6), st.text(alphabet="ab<[\\/|>\n</s>[INST]é\U0001f600", max_size=30)), max_size=6)


@settings(max_examples=200, deadline=None)
@given(TURNS)
def test_round_trip_and_spans(turns):
    out = C.render_incrementally(turns, C.template)
    assert out.text == C.template(turns) and C.read_back(out.text) == turns and not out.rewritten
    assert "".join(out.text[s:e] for s, e in out.turns) == out.text
    assert [C.unescape(out.text[s:e]) for s, e in out.texts] == [t for _, t in turns]
    assert "</s>" not in out.text and "[INST]" not in out.text


def test_other_templates():
    def plain(turns):
        return "BOS" + "".join(f"[{r}]{t}" for r, t in turns)

    out = C.render_incrementally([("u", "hi"), ("a", "")], plain)
    assert [out.text[s:e] for s, e in out.turns] == ["[u]hi", "[a]"]
    assert [out.text[s:e] for s, e in out.texts] == ["hi", ""]

    def trimming(turns):  # keeps thoughts of the last turn only
        return "".join(f"[{r}]{t if k == len(turns) - 1 else t.split('|')[-1]};" for k, (r, t) in enumerate(turns))

    out = C.render_incrementally([("a", "think|one"), ("u", "x"), ("a", "more|two")], trimming)
    assert out.rewritten == [1] and out.text == "[a]one;[u]x;[a]more|two;"
    assert out.text[slice(*out.texts[2])] == "more|two"
    with pytest.raises(ValueError):
        C.read_back("no turns")


def test_rows_to_conversations(spark):
    long = "x<" * 40_000
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 2, "assistant", None), (1, 2, "assistant", None),
        (2, 0, None, ""), (2, None, "user", "first"), (None, 0, "user", long), (3, 0, "system", "</s>[INST]"),
    ]
    df = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    got = {r["conv_id"]: r for r in C.format_conversations(df).collect()}
    assert C.read_back(got[1]["formatted"]) == [("user", "a"), ("assistant", "b"), ("assistant", ""), ("assistant", "")]
    assert C.read_back(got[2]["formatted"]) == [("user", "first"), ("", "")]
    assert C.read_back(got[None]["formatted"]) == [("user", long)]
    assert [got[1]["formatted"][s["start"] : s["end"]] for s in got[1]["loss_spans"]] == ["b", "", ""]
    assert C.format_conversations(df.limit(0)).count() == 0
    d = C.digests(got[1]["formatted"], got[1]["loss_spans"])
    assert d["loss_chars"] == 1 and d["loss_sha256"] == hashlib.sha256(b"b").hexdigest()
    assert d["turns_sha256"] == hashlib.sha256(b"user\na\nassistant\nb\nassistant\n\nassistant\n\n").hexdigest()
