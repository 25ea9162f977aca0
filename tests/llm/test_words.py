from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import words


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab É日\t\n\x0b\x0c\r\x1c\xa0", max_size=40)), max_size=6), st.booleans())
def test_words_are_those_of_bytes_split(texts, lower):
    raw, starts, ends, hashes, sizes = words.of_texts(texts, lower)
    want = [(t or "").encode() for t in texts]
    want = [(t.lower() if lower else t).split() for t in want]
    flat = [w for ws in want for w in ws]
    assert [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)] == flat
    assert sizes.tolist() == [len(ws) for ws in want]
    seen = {}
    assert all(seen.setdefault(w, h) == h for w, h in zip(flat, hashes.tolist(), strict=True))
    assert len(set(seen.values())) == len(seen)


def test_hash_does_not_depend_on_the_place(monkeypatch):
    monkeypatch.setattr(words, "CHUNK", 1000)
    long = "x" * 200_000
    text = " ".join(["one", long, "two"] + ["pad"] * 50_000 + ["one", long, "two"])
    _, _, _, h, _ = words.of_texts([text])
    assert h[:3].tolist() == h[-3:].tolist() and len(set(h.tolist())) == 4
