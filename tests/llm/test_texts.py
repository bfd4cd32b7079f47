"""Token counts, token files, chat pages and personal data against plain versions."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from tallyframe.llm import chat, pii, storage, token_counts, token_store

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_token_counts(spark, odd_docs, no_docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    extra = spark.createDataFrame(
        [(20, "  two  blanks  "), (21, " "), (22, "▁"), (23, "a▁b ▁ c"), (24, "tab\tand\r\nline \x00 \x1c end"),
         (25, "😀 ümläut 漢字"), (26, "<s> </s> <unk> <0x0A>"), (27, "\\ \\n \\\\")], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(extra)
    want = sorted(((r.doc_id or -1), len((r.text or "").encode()), len(library.encode(r.text or "")))
                  for r in docs.collect())
    got = sorted(((r.id or -1), r.n_bytes, r.n_tokens)
                 for r in token_counts.token_counts(docs, PIECES, parts=3).collect())
    assert got == want
    assert token_counts.token_counts(no_docs, PIECES).count() == 0


@given(st.lists(st.text(alphabet=" ab▁é\n\t\\'", max_size=12), max_size=3))
@settings(max_examples=60, deadline=None)
def test_pre_tokens_add_up(parts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    text = "".join(parts)
    pieces = sum(len(library.encode(p)) if p else 1 for p in token_counts.pre_tokens(text))
    assert pieces == len(library.encode(text))


@pytest.mark.parametrize("bits", [False, True])
def test_planes(bits):
    for n in (0, 1, 7, 8, 1000, 65_536):
        ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
        planes = token_store.to_planes(ids, bits)
        assert len(planes) == (32 if bits else 4)
        assert (token_store.from_planes(planes, n) == ids).all()


@pytest.mark.parametrize("bits", [False, True])
def test_token_files(spark, odd_docs, no_docs, tmp_path, bits):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    extra = spark.createDataFrame(
        [(30, "It's <|endoftext|>mid<|startoftext|> Ünḯcödé ΑΣ, a1b2 x\x1cy z."),
         (31, "The the, THE. don't ...,, İ")], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(extra)
    token_store.write_tokens(docs, str(tmp_path / "t"), WORDS, end_id=1, bits=bits)
    rows = token_store.read_tokens(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert [r.id for r in rows] == sorted([r.doc_id for r in docs.collect()], key=lambda i: (i is not None, i))
    texts = sorted((str(r.doc_id), tuple(library.encode(r.text or "", add_special_tokens=False).ids + [1]))
                   for r in docs.collect())
    assert sorted((str(r.id), tuple(r.ids)) for r in rows) == texts
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    token_store.write_tokens(no_docs, str(tmp_path / "none"), WORDS, end_id=1)
    assert token_store.read_tokens(spark, str(tmp_path / "none")).count() == 0


TRICKY = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|", "\n\n lead", " ", "", "é😀́x",
          "<|endoftext|> end", "a < b | c <| d", "trail \n"]


def test_chat_pages(spark):
    rows = [(1, k, ["user", "assistant"][k % 2], t) for k, t in enumerate(TRICKY * 20)]
    rows += [(2, 0, None, None), (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie"), (2, None, "user", "first"),
             (None, 5, "assistant", None), (None, 6, "odd<|role|>\n", "x"), (3, 0, "assistant", "long " * 20_000)]
    df = spark.createDataFrame([(*r, 0, "p") for r in rows],
                               "conv_id long, turn long, role string, text string, conv int, page string")
    pages = chat.formatted(df, BYTES)
    got = {r.conv: r for r in chat.digests(pages).collect()}
    turns = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] or -1, r[1] is not None, r[1] or 0, r[2] or "",
                                                        r[3] or "")):
        turns.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(turns)
    for c, own in turns.items():
        learned = "".join(t for role, t in own if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for role, t in own)
        assert (got[c].n_turns, got[c].turns_sha256) == (len(own), hashlib.sha256(whole.encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (
            len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert pages.where("conv = 1").count() == 4
    assert chat.digests(chat.formatted(df.limit(0), BYTES)).count() == 0


@given(st.text(alphabet="<|\\im>x", max_size=20))
def test_escape_is_undone(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)


def test_token_mask_by_search():
    starts, ends = np.array([5, 20]), np.array([10, 30])
    offsets = np.array([[0, 5], [4, 6], [6, 10], [10, 20], [19, 21], [30, 31], [29, 29]])
    assert chat.token_mask(offsets, starts, ends).tolist() == [False, True, True, False, True, False, True]


GRAMMARS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = []
    for kind, pattern in GRAMMARS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                    "card": lambda: 13 <= len(digits) <= 19 and sum(
                        sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0,
                    "phone": lambda: 9 <= len(digits) <= 15}[kind]
            if good():
                out.append((kind, *m.span()))
    return out


@given(st.one_of(st.text(alphabet="ab@.-+%", max_size=25), st.text(alphabet="0123.", max_size=25),
                 st.text(alphabet="0123456789 -", min_size=10, max_size=50),
                 st.text(alphabet="+12 ().-é", max_size=40), st.text(max_size=30)))
@settings(max_examples=600, deadline=None)
def test_base_spans_are_the_matches_of_the_grammars(text):
    machine = pii.anchors()
    assert [s for s in pii.spans(text, machine) if s[0] in GRAMMARS] == base_spans(text)


def test_added_spans():
    machine = pii.anchors()

    def kinds(text):
        return [(k, text[a:b]) for k, a, b in pii.spans(text, machine) if k not in GRAMMARS]
    assert kinds("see https://bob:s3cret@host.example/x") == [("login", "https://bob:s3cret@host.example")]
    assert kinds("https://host.example/a@b http://u:@h") == []
    assert kinds("IBAN: DE89 3704 0044 0532 0130 00 ok") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert kinds("IBAN DE88 3704 0044 0532 0130 00") == []
    assert kinds("SSN 123-45-6789, ssn#987-65-4321") == [("ssn", "123-45-6789")]
    assert kinds('token = "908038b7daaf91e730d2f64001c52934d43d9336"!! API_KEY: abcdefgh12345678') == [
        ("secret", "908038b7daaf91e730d2f64001c52934d43d9336"), ("secret", "abcdefgh12345678")]
    assert kinds("the token was found, password=short1, secret = withoutanydigitatall, tokens 12345678901234567890") == []


def test_personal_data(spark, odd_docs, no_docs):
    docs = odd_docs.select("doc_id", "text", "id").unionByName(spark.createDataFrame(
        [(50, "é a.b@c.de 1.2.3.4 1.2.3.999 +1 (555) 123-4567, 4111 1111 1111 1111", 1),
         # both grammars take all digits they can reach, fail, and are not tried again
         (51, "é a.b@c.de 1.2.3.4 1.2.3.999 +1 (555) 123-4567 4111 1111 1111 1111", 1)],
        "doc_id long, text string, id int"))
    got = {r.id: r for r in pii.personal_data(docs).collect()}
    assert got[50].spans == "email:2:10,ip:11:18,card:48:67,phone:29:46"
    assert got[51].spans == "email:2:10,ip:11:18"
    assert got[50].base_sha256 == hashlib.sha256(got[50].spans.encode()).hexdigest()
    assert got[3].spans == "" and got[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    masked = {r.doc_id: r.text for r in pii.masked(docs).collect()}
    assert masked[50] == "é [email] [ip] 1.2.3.999 [phone], [card]" and masked[3] is None
    assert pii.personal_data(no_docs).count() == 0


def test_shared_folder_without_setting():
    """A local session without spark.checkpoint.dir gets one temporary folder; another master an error."""
    class Conf(dict):
        def get(self, key, default):
            return super().get(key, default)

    class Session:
        def __init__(self, **conf):
            self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})
    local = Session(spark_master="local[2]", spark_app_id="a")
    assert storage.shared_dir(local) == storage.shared_dir(local) != storage.shared_dir(Session(spark_master="local[2]", spark_app_id="b"))
    assert storage.shared_dir(Session(spark_checkpoint_dir="s3://x/y/")) == "s3://x/y"
    with pytest.raises(ValueError):
        storage.shared_dir(Session(spark_master="yarn"))


def test_pages_of_equal_turn_numbers(spark):
    """A conversation without numbers, with equal numbers, or with long texts has pages of bounded size."""
    rows = ([(1, None, "user", f"t{k % 90}") for k in range(300)] + [(None, 4, "assistant", f"<|im_end|>{k}") for k in range(200)]
            + [(2, k, "assistant", "long " * 60_000) for k in range(3)] + [(3, 0, None, None)])
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pages = chat.formatted(df, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert max(p.n_turns for p in pages) <= chat.PAGE_TURNS and all(p.n_turns == 1 for p in pages if p.conv == 2)
    frame = spark.createDataFrame(pages, chat.PAGE)
    got = {r.conv: r for r in chat.digests(frame).collect()}
    for conv in (1, 2, 3, None):
        turns = sorted((t or 0, r or "", x or "") for c, t, r, x in rows if c == conv)
        text = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        learnt = "".join(x for _, r, x in turns if r == "assistant")
        assert got[conv][:5] == (conv, len(turns), hashlib.sha256(text.encode()).hexdigest(), len(learnt),
                                 hashlib.sha256(learnt.encode()).hexdigest())
