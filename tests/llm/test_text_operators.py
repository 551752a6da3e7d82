"""Language ID, BPE, PII, chat and mixing against brute force and on the edge cases."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from taxaloom.llm import byte_bpe, chat, language_id, mixing, pii

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"
EN = "the cat sat on the mat and the dog ran to the house with them "
DE = "der hund und die katze sind nicht in dem haus mit den kindern "


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), "x") for i, t, lang, s in rows], DOCS)


@pytest.fixture(scope="session")
def mixed(spark):
    random.seed(1)
    rows = [(i, " ".join(random.sample((EN if i % 2 else DE).split(), 8)), "en" if i % 2 else "de", f"s{i % 3}") for i in range(80)]
    rows += [(100, None, "en", None), (101, "", "de", "s1"), (102, "123 !!", None, "s1"), (3, rows[3][1], "en", "s0")]
    return documents(spark, rows)


def test_language_held_out_accuracy(mixed):
    model = language_id.fit(mixed.where(~language_id.held_out()))
    found = language_id.predict(mixed, model).withColumn("held_out", language_id.held_out()).collect()
    judged = [r for r in found if r["held_out"] and r["doc_id"] < 100]
    assert judged and all(r["lang_pred"] == r["lang"] for r in judged)
    for r in found:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] >= 100:
            assert (r["lang_pred"], r["score"], r["accepted"]) == ("und", 0.0, False)


def test_language_empty_table_and_clashing_columns(spark, mixed):
    empty = mixed.where("false").withColumnRenamed("extra", "score")
    model = language_id.fit(empty)
    assert language_id.predict(empty, model).columns.count("score") == 1
    assert language_id.predict(mixed, model).where("lang_pred <> 'und'").count() == 0


def test_language_rejects_foreign_text(spark, mixed):
    model = language_id.fit(mixed)
    odd = documents(spark, [(1, "ждчф щшъыь эюя", None, None), (2, EN, None, None)])
    assert [r["accepted"] for r in language_id.predict(odd, model).orderBy("doc_id").collect()] == [False, True]


def test_language_rejects_latin_script_and_junk(spark):
    rng = random.Random(5)
    parts = {"en": "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve the and ing ion ly", "de": "en er ch de ei ie in te ge un nd ic es be he st sch ung keit lich der und ein \u00e4 \u00fc \u00f6 \u00df"}
    word = lambda k: "".join(rng.choices(parts[k].split(), k=rng.randint(1, 4)))
    text = lambda k, n: " ".join(word(k) for _ in range(n))
    model = language_id.fit(documents(spark, [(i, text(k, rng.randint(3, 150)), k, None) for i, k in enumerate(["en", "de"] * 150)]))
    letters = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    odd = ["Kaikki ihmiset syntyv\u00e4t vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.", "Wszyscy ludzie rodz\u0105 si\u0119 wolni i r\u00f3wni pod wzgl\u0119dem swej godno\u015bci i swych praw.", *[letters(200) for _ in range(5)], *[" ".join(letters(rng.randint(2, 9)) for _ in range(60)) for _ in range(5)]]
    clean = [text(k, n) for k in ("en", "de") for n in (3, 5, 10, 40, 150) for _ in range(8)]
    found = [r["accepted"] for r in language_id.predict(documents(spark, [(i, t, None, None) for i, t in enumerate(odd + clean)]), model).orderBy("doc_id").collect()]
    assert not any(found[: len(odd)]) and sum(found[len(odd) :]) >= 0.95 * len(clean)


@pytest.fixture(scope="session")
def bpe():
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return open(path, "rb").read(), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(spark, bpe):
    content, enc = bpe
    random.seed(2)
    parts = ["ab", "aaa", "the", "ing er", "日本語", "ß é", "0123", "\n \t", "😀", "<|endoftext|>", "aaaaaaaaaaaaaaaa", "'ll", "\x1c\x85​"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 60))) for _ in range(120)] + ["a" * 5000, "ab" * 4000, "", None]
    rows = byte_bpe.round_trip(documents(spark, [(i, t, None, None) for i, t in enumerate(texts)]), content, P.PATTERN).collect()
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r["doc_id"]] or ""
        ids = enc.encode_ordinary(t)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_bpe_replay_of_random_words(bpe, monkeypatch):
    content, enc = bpe
    rng, v = random.Random(3), byte_bpe.vocabulary(content)
    token = sorted(enc.token_byte_values())
    words = ["".join(rng.choices(["a", "b", "ab", "th", "er", "é", "日", "0", " ", "--"], k=rng.randint(1, 30))).encode() for _ in range(3000)]
    words += [b"".join(rng.choices(token, k=rng.randint(1, 5))) for _ in range(3000)] + [b"aab" * 500]
    for ranks in (1, 64, 1 << 20):
        monkeypatch.setattr(byte_bpe, "RANGE", ranks)
        some = words if ranks > 1 else words[:300]
        for w, ids in zip(some, v.replay(some), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == enc._encode_single_piece(w)


def test_bpe_parts_repeated_rows_and_clashing_columns(spark, bpe, monkeypatch):
    content, enc = bpe
    monkeypatch.setattr(byte_bpe, "PART_CHARS", 10)
    rows = [(1, "the theory of 日本 names", None, None), (1, "the theory of 日本 names", None, None), (None, None, None, None), (2, "", None, None)]
    found = byte_bpe.encode_documents(documents(spark, rows).withColumnRenamed("extra", "ids").withColumnRenamed("lang", "n_tokens"), content, P.PATTERN)
    assert sorted(found.columns) == sorted(["doc_id", "text", "source", "n_chars", "ids", "n_tokens"])
    assert [r["n_tokens"] for r in found.orderBy(F.col("doc_id").asc_nulls_first()).collect()] == [0, *[len(enc.encode_ordinary(rows[0][1]))] * 2, 0]


def test_bpe_empty_table(spark, bpe):
    assert byte_bpe.round_trip(documents(spark, []), bpe[0], P.PATTERN).count() == 0


def brute_spans(text):
    """The base patterns as given, each search anew from the end of the last match."""
    import re

    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_pii_base_spans_equal_the_patterns():
    random.seed(3)
    parts = ["a", "b.c", "@", ".", "-", " ", "1", "22", "255", "256", "4785380592391139", "4785 3805 9239 1139", "+1 (743) 555-3824", "+", "é", "x@y.z", "192.168.0.1", "%", "\n"]
    for _ in range(3000):
        t = "".join(random.choice(parts) for _ in range(random.randint(0, 14)))
        assert pii.base_spans(t) == brute_spans(t), t
    assert pii.base_spans(None) == pii.base_spans("") == []


def test_pii_long_runs_are_linear():
    assert pii.base_spans("a" * 300_000 + "1" * 300_000 + "+1" + "(" * 300_000) == []


def test_pii_learns_a_pattern_and_finds_unseen_identifiers(spark):
    cards = ["4785380592391139", "4539578763621486", "4916338506082832", "4532015112830366"]
    rows = [(i, f"some words my card number: {cards[i % 4]} and more words here {i}", None, None) for i in range(20)]
    rows += [(50, "the card number: 4111-22-9999x was typed wrongly", None, None), (51, "no number here, the word 1234567 stands alone", None, None), (52, None, None, None), (53, "", None, None)]
    docs = documents(spark, rows)
    patterns = pii.learn(docs)
    assert patterns.get("number:") == "card"
    found = {r["doc_id"]: r for r in pii.report(docs).collect()}
    assert found[50]["n_card"] == 0 and found[50]["spans"].startswith("card:17:")
    assert found[51]["spans"] == found[52]["spans"] == found[53]["spans"] == ""
    masked = {r["doc_id"]: r for r in pii.masked(docs).collect()}
    assert "[CARD]" in masked[50]["text"] and cards[0] not in masked[0]["text"] and masked[0]["n_chars"] == len(masked[0]["text"])
    assert masked[51]["text"] == rows[21][1] and masked[52]["text"] is None
    assert pii.masked(docs).columns == docs.columns and pii.masked(docs.where("false")).count() == 0


def test_pii_fillers_run_over_whole_groups():
    at = lambda t: [a and t[a[0] : a[1]] for _, a in pii._slots(t, {"iban:": [], "3704": []})]
    assert at("my iban: DE89 3704 0044 0532 0130 00 is new") == ["DE89 3704 0044 0532 0130 00", "0044 0532 0130 00"]
    assert at("my iban: 12345 6789 1234 5678 9012 34ab") == ["12345 6789 1234 5678 9012"]
    assert at("my iban: nothing here 1") == [None] and at("iban: (a@b.c)") == ["(a@b.c)"] and at("iban: 1 2 3") == ["1 2 3"]
    assert pii.all_spans("iban: " + "1 " * 100_000, {"iban:": "card", "1": "card"})[0][1:] == (6, 200_005)


def test_pii_shapes_find_numbers_that_base_matches_run_past(spark):
    rng = random.Random(4)
    phone = lambda: f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    rows = [(i, f"{word()} {phone()} {word()}", None, None) for i in range(30)]
    rows += [(40, f"{word()} +1 (204) 555-1234 190.137.223.9 {word()}", None, None), (41, f"{word()} 4785380592391130 {word()}", None, None), (42, "x" * 200_000 + " 1", None, None)]
    docs = documents(spark, rows).withColumn("base", F.lit(1)).withColumn("__found", F.lit(2)).withColumn("spans", F.lit(3))
    found = {r["doc_id"]: r for r in pii.report(docs.union(docs.where("doc_id = 40"))).collect()}
    assert found[40]["n_phone"] == 0 and found[40]["spans"] == "ip:25:38,phone:7:24"
    assert found[41]["spans"] == found[42]["spans"] == ""
    assert pii.masked(docs).columns == docs.columns
    assert pii._before("12number:", 9) == ["number:"] and pii._before("a b  c ", 7) == ["c", "b c"] and pii._before(" 1", 2) == []


def test_pii_shapes_have_any_number_of_groups_and_any_length(spark):
    rng = random.Random(5)
    digits = lambda n: "".join(rng.choices("123456789", k=n))
    phone = lambda: f"+1 {digits(3)} {digits(2)} {digits(2)} {digits(2)} {digits(2)}"
    mail = lambda: ".".join("".join(rng.choices("abcdef", k=9)) for _ in range(9)) + f"{digits(3)}@{digits(1)}x.example"
    word = lambda: "".join(rng.choices("ghijklm", k=6))
    rows = [(i, f"{word()} {phone()} {word()} {mail()} {word()}", None, None) for i in range(30)]
    rows.append((40, f"{word()} +1 204 55 12 34 56 190.137.223.9 {word()}", None, None))
    docs = documents(spark, rows)
    patterns = pii.learn(docs)
    assert pii._shape("+1 204 55 12 34 56") in patterns and any(len(p) > 12 and "@" in p for p in patterns)
    assert pii.all_spans(rows[-1][1], patterns) == [("ip", 26, 39), ("phone", 7, 25)]
    assert len(mail()) > 64 and pii._shape(mail()) in patterns


def test_pii_support_does_not_grow_with_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(pii, "PATTERN_BLOCK", 5)
    cards = ["4785380592391139", "4539578763621486", "4916338506082832", "4532015112830366"]
    rows = [(i, f"words my card number: {cards[i % 4]} and more", None, None) for i in range(4)]
    rows.append((9, " ".join(f"addr 10.{i % 200}.{i // 200}.1" for i in range(200_000)), None, None))
    assert pii.learn(documents(spark, rows)).get("number:") == "card"


def test_chat_round_trip_and_masks(spark):
    random.seed(4)
    parts = ["</s>", "[INST]", "[/INST]", "<|turn|>", "<|end|>\n", "\\", "word ", "é\n", "<s>", "<<SYS>>", "<", "|"]
    rows = []
    for c in range(12):
        for t in range(random.randint(1, 40)):
            role = "system" if t == 0 and c % 2 else random.choice(["user", "assistant"])
            rows.append((c, t, role, None if random.random() < 0.05 else "".join(random.choice(parts) for _ in range(random.randint(0, 60)))))
    rows += [(None, 0, "user", "null id"), (None, None, None, None)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r["conv_id"]: r for r in chat.digest(conv).collect()}
    assert len(found) == 14 and found[-7]["n_turns"] == 2
    for c in range(12):
        turns = [r for r in rows if r[0] == c]
        said = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        assert found[c]["n_turns"] == len(turns)
        assert found[c]["turns_sha256"] == hashlib.sha256("".join(f"{r[2]}\n{r[3] or ''}\n" for r in turns).encode()).hexdigest()
        assert (found[c]["loss_chars"], found[c]["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    for w in chat.format_windows(conv, budget=100).collect():
        assert w["tokens"] <= 100 or w["turns"] == 1
    assert chat.format_windows(conv.where("false")).count() == 0


def test_escape_is_reversible_and_hides_control_strings():
    for t in ["</s>[INST] ok [/INST]", "\\", "<\\|", "<<|", "[[INST]", "a<|turn|>b\\", ""]:
        assert chat.unescape(chat.escape(t)) == t
        assert not any(c in chat.escape(t) for c in chat.CONTROL)


def test_mixing_targets(spark):
    docs = documents(spark, [(i, "w " * (i % 7), None, [None, "a", "b", "c"][i % 4]) for i in range(400)] + [(1000, None, None, "d")])
    rows = mixing.digest(docs).collect()
    assert len(rows) == 401
    by = {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        got = by.setdefault(r["source_size"], [r["target"], 0])
        got[1] += r["taken"]
    assert all(abs(t - n) <= 1 for t, n in by.values())
    total = sum(by)
    assert abs(sum(t for t, _ in by.values()) - 1.5 * total) < 1e-6
    again = mixing.digest(docs).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert mixing.digest(docs.where("false")).count() == 0


def test_mixing_stream_is_ordered_and_whole(spark):
    docs = documents(spark, [(i, f"{i} " + "w " * (i % 7), None, "ab"[i % 2]) for i in range(200)])
    stream = mixing.mixed(docs)
    assert stream.columns == docs.columns
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = stream.collect()
    assert all(text[r["doc_id"]] == r["text"] for r in rows) and max(sum(1 for r in rows if r["doc_id"] == i) for i in text) <= 2


def test_chat_large_turns_repeats_and_extra_columns(spark):
    row = lambda i, role, n: (1, i, role, " ".join(["w"] * n))
    rows = [row(0, "system", chat.BUDGET * 6 // 10), *[row(i, "user" if i % 2 else "assistant", 20) for i in range(1, 40)], row(40, "assistant", 900), row(40, "assistant", 900)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(1)).withColumn("loss", F.lit("x"))
    windows = chat.format_windows(turns).collect()
    assert sum(w["turns"] for w in windows) == len(rows)
    assert all(w["tokens"] <= chat.BUDGET or w["turns"] == 1 for w in windows)
    assert chat.read_back(chat.format_windows(turns)).first()["n_turns"] == len(rows)
    # a system turn of over half of the budget opens every window all the same; one over the budget the first alone
    opening = windows[0]["text"][: chat.BUDGET]
    assert len(windows) > 3 and all(w["text"].startswith(opening) for w in windows)
    large = turns.withColumn("text", F.when(F.col("role") == "system", F.repeat(F.lit("w "), chat.BUDGET + 5)).otherwise(F.col("text")))
    again = chat.format_windows(large).collect()
    assert [w["turns"] for w in again if w["tokens"] > chat.BUDGET] == [1, 1, 1] and sum(w["turns"] for w in again) == len(rows)


def test_mixing_keeps_clashing_columns_and_repeated_rows(spark):
    rows = [(i % 30, "w " * (i % 7 + 1), "en", f"s{i % 3}") for i in range(90)] + [(100, "long " * 50_000, "en", "s1")]
    docs = documents(spark, rows)
    for name in ("size", "passes", "taken", "target", "first", "source_size", "t", "kept", "block", "h"):
        docs = docs.withColumn(name, F.lit(name))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and {r["size"] for r in out.collect()} == {"size"}
    assert mixing.digest(docs).count() == len(rows)
