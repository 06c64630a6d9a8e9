"""Token counts, token files, packing, chat, decontamination, language ID: brute force, round trips, odd inputs."""

import hashlib
import io
import json
import os
import random
import shutil
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rasterloom.llm import chat, decontaminate, encoding, language, packing, registry, token_counts, token_files
from rasterloom.session import table
from tests.conftest import SF
from tests.oracle import connect, same

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, ids string, token string, __x int, lang string, source string"
LONG = "the quick brown fox " * 20_000
ODD = [
    (3, "hello world", "a", "b", 1, "en", "s"),
    (3, "hello world", "a", "b", 1, "en", "s"),  # repeats
    (None, "no id", "a", "b", 1, None, "s"),
    (None, None, None, None, None, None, None),
    (7, None, "a", "b", 1, "en", "s"),
    (8, "", "a", "b", 1, "en", "s"),
    (9, " \n\t ", "a", "b", 1, "en", "s"),
    (1, LONG, "a", "b", 1, "en", "s"),
    (2, "Ünïcödé 漢字 e\u0301 it's <|endoftext|> don’t", "a", "b", 1, "fr", "s"),
    (4, "a" * 5000, "a", "b", 1, "en", "s"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs():
    return connect(SF).execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


LIBRARY, OWN = Tokenizer.from_file(WORD_BPE), encoding.TextEncoder(WORD_BPE, 1)


def ids_of(text):
    found = LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]
    return np.array(found, dtype="<u4")


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="aAbéÉßÿ '’.,12\n\t\u00a0\u0301<|>endoftx×÷", max_size=60)))
def test_encoder_equals_the_library(text):
    assert np.frombuffer(OWN.encode([text])[0], "<u4").tolist() == ids_of(text).tolist()


def test_only_independent_words_are_cached():
    assert encoding.words_are_independent(WORD_BPE)
    assert not encoding.words_are_independent(BYTE_BPE)
    plain = Tokenizer.from_file(BYTE_BPE)
    texts = ["Hello  world", None, "", "x\n\ny"]
    got = encoding.TextEncoder(BYTE_BPE).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def naive_pieces(word, begin, follow):
    at, n = 0, 0
    while at < len(word):
        pieces = follow if at else begin
        for end in range(len(word), at, -1):
            if word[at:end] in pieces:
                break
        else:
            return None
        at, n = end, n + 1
    return n


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=5), max_size=12), st.sets(st.text("abc", min_size=1, max_size=5), max_size=12), st.text("abcd", min_size=1, max_size=12))
def test_automaton_equals_greedy_search(begin, follow, word):
    assert token_counts.build(sorted(begin), sorted(follow)).count(word) == naive_pieces(word, begin, follow)


def test_token_counts_query(spark, docs):
    begin, follow = token_counts.sentencepiece_vocabulary(registry.PIECES)
    b, f = set(begin), set(follow)
    want = {}
    for doc_id, text in docs:
        words = token_counts.WORD.findall(text or "")
        counts = [naive_pieces(w, b, f) for w in words]
        want[doc_id] = (len(words), sum(c or 1 for c in counts), counts.count(None))
    assert {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in registry.op1_token_counts(spark, SF).collect()} == want


def test_token_counts_of_odd_rows(spark, odd, empty):
    automaton = token_counts.build(["hello", "th"], ["e", "o"])
    rows = token_counts.token_counts(odd, automaton).collect()
    assert len(rows) == len(ODD)
    assert sorted((r.n_words, r.n_tokens, r.n_unknown) for r in rows if r.doc_id == 3) == [(2, 2, 1)] * 2
    assert {(r.n_words, r.n_tokens) for r in rows if r.doc_id in (7, 8, 9)} == {(0, 0)}
    assert token_counts.token_counts(empty, automaton).count() == 0


def test_wordpiece_lists():
    assert token_counts.wordpiece_vocabulary(["un", "##aff", "##able", "", "##"]) == (["un"], ["aff", "able"])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=50))
def test_integer_coding_round_trip(values):
    control, data = token_files.compress(np.array(values, dtype=np.uint32))
    assert token_files.expand(control, data, len(values)).tolist() == values


def test_token_files_query(spark, docs):
    want, start = {}, 0
    for doc_id, text in docs:
        ids = ids_of(text)
        want[doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in registry.op2_token_files(spark, SF).collect()} == want


def test_token_files_of_odd_rows(spark, odd, empty):
    files = token_files.write_token_files(odd, WORD_BPE, 1)
    rows = sorted(token_files.read_token_files(spark, files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r[0] for r in ODD), key=lambda d: (d is not None, d or 0))
    assert [r.start for r in rows] == list(np.cumsum([0] + [r.n_tokens for r in rows])[:-1])
    texts = {(r[0], ids_of(r[1]).tobytes()) for r in ODD}
    assert {(r.doc_id, bytes(r.ids)) for r in rows} == texts
    none = token_files.write_token_files(empty, WORD_BPE, 1)
    assert token_files.read_manifest(none)["files"] == [] and token_files.read_digests(spark, none).count() == 0


def test_frequent_ids_take_fewer_bytes(spark):
    frame = spark.createDataFrame([(i, "the " * 50 + f"word{i}") for i in range(50)], "doc_id long, text string")
    files = token_files.write_token_files(frame, WORD_BPE, 1)
    stored = ids = 0
    for listed in token_files.read_manifest(files)["files"]:
        path = f"{files}/{listed['file']}".removeprefix("file://")
        assert os.path.getsize(path) == listed["bytes"]
        with open(path, "rb") as src:
            for _, counts, _, size in token_files.read_blocks(src):
                stored, ids = stored + size, ids + counts.sum()
    assert stored < 1.5 * ids


def test_a_folder_of_token_files_is_read_alone(spark, odd, tmp_path):
    """Moved elsewhere, with a file of a failed task in it; a listed file that holds other ids is an error."""
    made = token_files.write_token_files(odd, WORD_BPE, 1).removeprefix("file://")
    moved = f"{tmp_path}/moved"
    shutil.move(made, moved)
    with open(f"{moved}/part-000000-left.rltk", "wb") as out:
        out.write(b"half")
    rows = token_files.read_token_files(spark, moved).collect()
    assert len(rows) == len(ODD)
    listed = token_files.read_manifest(moved)
    assert sum(f["documents"] for f in listed["files"]) == len(ODD)
    listed["files"][0]["ids"] += 1
    with open(f"{moved}/manifest.json", "w") as out:
        json.dump(listed, out)
    with pytest.raises(Exception, match="manifest"):
        token_files.read_token_files(spark, moved).collect()


def test_a_cut_token_file_is_an_error():
    out = io.BytesIO(token_files.MAGIC + b"\1")
    with pytest.raises(EOFError):
        list(token_files.read_blocks(out))


def check_pieces(rows, texts):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, pieces in by_doc.items():
        ids = ids_of(texts[doc_id])
        pieces.sort(key=lambda r: r.start)
        assert [p.start for p in pieces] == list(np.cumsum([0] + [p.length for p in pieces])[:-1])
        assert sum(p.length for p in pieces) == len(ids) == pieces[0].doc_tokens
        for p in pieces:
            assert p.length & (p.length - 1) == 0 and p.length <= 2048 and p.offset == 0
            yield p, ids[p.start : p.start + p.length]


def test_packing_query(spark, docs):
    rows = registry.op8_packing(spark, SF).collect()
    for p, ids in check_pieces(rows, dict(docs)):
        assert p.ids_crc32 == zlib.crc32(ids.tobytes())
    assert len({r.sequence_id for r in rows}) == len(rows) and {r.doc_id for r in rows} == {d for d, _ in docs}


def test_packing_of_odd_rows(spark, odd, empty):
    rows = packing.pack(odd, WORD_BPE).collect()
    assert sum(r.length for r in rows) == sum(len(ids_of(r[1])) for r in ODD)
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert sorted(r.length for r in rows if r.doc_id in (7, 8, 9)) == [1, 1, 1]
    assert packing.pack(empty, WORD_BPE).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd, WORD_BPE, 1000)


@given(st.integers(0, 10**6), st.sampled_from([1, 64, 2048]))
def test_piece_lengths(n, most):
    lengths = packing.piece_lengths(n, most)
    assert sum(lengths) == n and all(x <= most and x & (x - 1) == 0 for x in lengths) and lengths == sorted(lengths, reverse=True)


def test_chat_query_equals_sql(spark):
    same(registry.op3_chat_format(spark, SF), connect(SF), chat.DIGEST_SQL)


LOG = "conv_id long, seq long, turn long, nth int, kind string, role string, text string"
EVENTS = [
    (1, 1, 1, 0, "message", "user", "hi"), (1, 2, 2, 0, "message", "assistant", ""), (1, 3, 2, 0, "delta", "assistant", "a"), (1, 4, 2, 0, "delta", "assistant", "b"),
    (1, 5, 1, 0, "edit", "user", "hello"), (1, 6, 2, 0, "regenerate", "assistant", None), (1, 7, 2, 0, "delta", "assistant", "c"), (1, 8, 2, 0, "delta", "assistant", "d"),
    (2, 1, 1, 0, "delta", None, "x"), (2, 2, 1, 0, "delta", None, None), (2, 3, 1, 1, None, "tool]\\[INST]", "</s>[ROLE x] \\ [/ROLE]"), (2, 3, 1, 2, None, "tool]\\[INST]", "</s>[ROLE x] \\ [/ROLE]"),
    (3, 1, 1, 0, "message", "assistant", "x [/INST] <s> \\< [" * 50), (4, 1, 1, 0, "message", None, None), (None, None, None, None, "message", "user", "null ids"),
    # A regeneration takes later turns with it, but not what is logged afterwards, and an earlier one may be taken back by a later one.
    (5, 1, 1, 0, "message", "user", "q"), (5, 2, 2, 0, "message", "assistant", "bad"), (5, 3, 3, 0, "message", "user", "why?"), (5, 4, 4, 0, "message", "assistant", "sorry"),
    (5, 5, 4, 0, "regenerate", "assistant", "really"), (5, 6, 2, 0, "regenerate", "assistant", "go"), (5, 7, 2, 0, "delta", "assistant", "od"), (5, 8, 3, 0, "message", "user", "thanks"),
    (6, 1, 1, 0, "message", "assistant", "long é漢 " * 100_000), (6, 2, 2, 0, "message", "user", None), (6, 3, 3, 0, "message", "assistant", "ü"),
]


def fold_by_hand(events):
    out = {}
    for conv, _, turn, nth, kind, role, text in sorted(events, key=lambda e: (str(e[0]), e[1] or 0, e[4] or "message", e[5] or "", e[6] or "")):
        slots = out.setdefault(conv, {})
        at, kind = (turn or 0, nth or 0), kind if kind in ("delta", "edit", "regenerate") else "message"
        if kind == "regenerate":
            for later in [s for s in slots if s >= at]:
                del slots[later]
        if kind == "message" or at not in slots:
            slots[at] = [role or "", text or ""]
        elif kind == "delta":
            slots[at][1] += text or ""
        else:
            slots[at][1] = text or ""
    return {c: [tuple(slots[s]) for s in sorted(slots)] for c, slots in out.items()}


def read_back(chats):
    return {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chats.select("conv_id", chat.parse(F.col("formatted")).alias("turns")).collect()}


def test_chat_folds_and_reads_back(spark):
    events = spark.createDataFrame(EVENTS, LOG).withColumn("piece", F.lit(1)).withColumn("back", F.lit("x"))
    chats = chat.render(chat.final_messages(events))
    want = fold_by_hand(EVENTS)
    assert read_back(chats) == want and want[5] == [("user", "q"), ("assistant", "good"), ("user", "thanks")]
    for r in chat.digests(chats).collect():
        loss = "".join(t for role, t in want[r.conv_id] if role == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest()) and r.n_turns == len(want[r.conv_id])
    assert chat.digests(chat.render(chat.final_messages(events.limit(0)))).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 1), st.sampled_from(["message", "delta", "edit", "regenerate", "?"]), st.sampled_from(["user", "assistant"]), st.text("ab[", max_size=3)), min_size=1, max_size=25))
def test_any_log_folds_as_by_hand(spark, log):
    events = [(1, n, *e) for n, e in enumerate(log)]
    assert read_back(chat.render(chat.final_messages(spark.createDataFrame(events, LOG)))) == fold_by_hand(events)


def test_conversations_are_folded_from_a_full_log(spark):
    """Every kind of event is in the log, some conversations lose drafts of later turns, and rows that tie or repeat are kept."""
    rows = [(1, 1, "user", "same"), (1, 1, "user", "same"), (1, 1, "assistant", "tie"), (2, None, "user", None), (None, 3, None, "x"), (3, 2**63 - 1, "user", "last"), (4, 1, "assistant", "")]
    rows += [(5, n, "assistant" if n % 2 else "user", f"text {n} </s>") for n in range(60)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("nth", F.lit("x"))
    events = chat.conversation_events(turns)
    log = events.collect()
    assert {e.kind for e in log} == {"message", "delta", "edit", "regenerate"}
    assert any(e.kind == "message" and e.turn != e.seq.turn for e in log)
    got = read_back(chat.render(chat.final_messages(events)))
    want = {}
    for conv, _, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    assert got == want


def test_loss_spans_are_places_in_the_formatted_text(spark):
    events = spark.createDataFrame(EVENTS, LOG)
    want = fold_by_hand(EVENTS)
    for r in chat.render(chat.final_messages(events)).collect():
        raw = r.formatted.encode()
        cut = [raw[x.start : x.start + x.length].decode().replace("\\\\", "\0").replace("\\", "").replace("\0", "\\") for x in r.loss]
        assert cut == [t for role, t in want[r.conv_id] if role == "assistant"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="</s>[]INSTOUROLE \\\nx", max_size=40), min_size=1, max_size=6))
def test_no_text_is_taken_for_a_mark(spark, texts):
    roles = ["user", "assistant", "system", "tool", "[INST]", ""]
    rows = [(1, i, i, 0, "message", roles[i % 6], t) for i, t in enumerate(texts)]
    chats = chat.render(chat.final_messages(spark.createDataFrame(rows, LOG)))
    got = chats.select(chat.parse(F.col("formatted")).alias("t")).first().t
    assert [(t.role, t.text) for t in got] == [(r[5], r[6]) for r in rows]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=8), st.lists(st.integers(1, 4), max_size=14))
def test_window_distance_equals_dynamic_programming(item, window):
    masks = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    column = list(range(len(item) + 1))
    best = column[-1]
    for w in window:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(column[i] + (x != w), column[i + 1] + 1, new[i] + 1))
        column = new
        best = min(best, column[-1])
    assert decontaminate.window_distance(item, masks, window)[0] == best


def test_decontamination_finds_edited_items(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(12, 50)))) for i in range(60)]
    docs, planted = [], set()
    for d in range(300):
        words = rng.choices(vocabulary, k=rng.randrange(50, 400))
        if d % 3 == 0:
            item_id, text = items[rng.randrange(60)]
            part = text.split()
            edits = decontaminate.allowed_edits(len(part), 0.8)
            for _ in range(edits if d % 2 else 0):
                at = rng.randrange(len(part))
                part[at : at + rng.randrange(2)] = rng.choices(vocabulary, k=rng.randrange(2))
            at = rng.randrange(len(words))
            words[at:at] = part
            planted.add((d, item_id))
        docs.append((d, " ".join(words).upper()))
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    exact = {(d, i) for d, i in planted if d % 2 == 0}
    assert got <= planted and exact <= got and len(got) >= 0.95 * len(planted)


def found_share(index, copies):
    """Of (item number, edited words): the share found among other words of the items."""
    rng = np.random.default_rng(5)
    around = rng.integers(1, len(index.vocabulary) + 1, (len(copies), 2, 20))
    docs = [np.array([*a[0], *words, *a[1]], np.int64) for a, (_, words) in zip(around, copies, strict=True)]
    found = decontaminate.search(index, index.bags(), index.masks(), index.bands(), docs)
    return sum(index.item_ids[n] in {leak[0] for leak in leaks} for (n, _), leaks in zip(copies, found, strict=True)) / len(copies)


def random_items(shortest, longest, n, seed):
    rng = np.random.default_rng(seed)
    return [(i, " ".join(f"w{w}" for w in rng.integers(0, 3000, rng.integers(shortest, longest + 1)))) for i in range(n)]


@pytest.mark.parametrize("size", range(5, 12))
def test_decontamination_finds_items_with_an_edited_first_word(size):
    index = decontaminate.build_index(random_items(size, size, 100, size), 0.8, 0.99, 7)
    replaced = [(n, [0, *item[1:]]) for n, item in enumerate(index.items)]
    deleted = [(n, item[1:]) for n, item in enumerate(index.items)]
    assert found_share(index, replaced + deleted) >= 0.95


@pytest.mark.parametrize("size", [*range(1, 12), 14, 19, 25, 33, 47, 64, 90, 128, 200, 256])
def test_every_length_is_found_at_the_recall_by_walks(size):
    """Copies with the most edits allowed, against the recall measured when the index is built."""
    index = decontaminate.build_index(random_items(size, size, 60, size), 0.8, 0.9, 7)
    assert index.exact_items == 0 and min(index.recalls.values()) >= 0.9
    assert found_share(index, random_copies(index, 5, size)) >= 0.9


def test_walks_cover_whole_items():
    items = [list(range(1, 41))]
    walk = decontaminate._walk(np.random.default_rng(0), items, np.array([True]), 40)
    cursors, cursor = [], 0
    for t in range(max(int(s.steps[-1]) for s in walk.sets) + 1):
        cursors.append(cursor)
        cursor += int(walk.moves(t)[items[0][cursor]]) if cursor < 40 else 0
    seen = sorted({cursors[t] for s in walk.sets for t in s.steps})
    assert seen[0] < 8 and seen[-1] > 32  # steps are sampled from all of the item


def random_copies(index, each, seed):
    rng = np.random.default_rng(seed)
    return [(n, decontaminate._edited(rng, item, index.edits[n])) for n, item in enumerate(index.items) for _ in range(each)]


def test_every_length_of_item_reaches_the_recall():
    index = decontaminate.build_index(random_items(5, 40, 700, 3), 0.8, 0.99, 7)
    copies = random_copies(index, 10, 9)
    for edits in sorted(set(index.edits)):
        assert found_share(index, [c for c in copies if index.edits[c[0]] == edits]) >= 0.985
    assert min(index.recalls.values()) >= 0.99


@pytest.mark.parametrize("recall", [0.99, 1.0])
def test_items_that_walks_miss_are_found_exactly(monkeypatch, recall):
    monkeypatch.setattr(decontaminate, "MAX_WALKS", 1)
    index = decontaminate.build_index(random_items(5, 40, 200, 4) + random_items(300, 310, 2, 5), 0.8, recall, 7)
    assert found_share(index, random_copies(index, 5, 6)) == 1.0 and index.exact_items == 202


@pytest.mark.parametrize("item", ["敏捷的棕色狐狸跳过了懒狗，然后在河边休息。", "すばやい茶色のキツネがのろまな犬を飛び越える", "สุนัขจิ้งจอกสีน้ำตาลกระโดดข้ามสุนัขขี้เกียจ"])
def test_decontamination_finds_items_in_scripts_without_spaces(item):
    index = decontaminate.build_index([(1, item)], 0.8, 0.99, 7)
    texts = [f"前文{item}後文 and more", f"x {item[3:]} y", "前文後文 and more"]
    docs = [decontaminate.word_ids(t, index.vocabulary) for t in texts]
    assert [len(leaks) for leaks in decontaminate.search(index, index.bags(), index.masks(), index.bands(), docs)] == [1, 1, 0]
    assert decontaminate.words_of("Ab_1 漢字kana・カー ok") == ["ab_1", "漢", "字", "kana", "カ", "ー", "ok"]


def test_items_below_five_words_match_exact_copies():
    index = decontaminate.build_index([(1, "hello wide world"), (2, "狐狸")], 0.8, 0.99, 7)
    docs = [decontaminate.word_ids(t, index.vocabulary) for t in ["say Hello, wide world!", "hello world", "棕狐狸"]]
    assert [[leak[0] for leak in leaks] for leaks in decontaminate.search(index, index.bags(), index.masks(), index.bands(), docs)] == [[1], [], [2]]


def test_decontamination_query_equals_brute_force(spark):
    con = connect(SF)
    docs, items = (con.execute(f"SELECT * FROM {t}").fetchall() for t in ("documents", "benchmark"))
    index = decontaminate.build_index([(i, t) for i, t in items], 0.8, 0.99, 7)
    masks = index.masks()
    want = set()
    for row in docs:
        words = [index.vocabulary.get(w, 0) for w in decontaminate.words_of(row[1])]
        for n, item in enumerate(index.items):
            if decontaminate.window_distance(item, masks[n], words)[0] <= index.edits[n]:
                want.add((row[0], index.item_ids[n]))
    got = {(r.doc_id, r.item_id) for r in registry.op6_decontaminate(spark, SF).collect()}
    assert got <= want and len(got) >= 0.97 * len(want) and want


def test_decontamination_of_odd_rows(spark, odd, empty):
    items = [(1, "the quick brown fox the quick brown"), (1, "the quick brown fox the quick brown"), (None, "fox the quick brown fox the"), (2, None), (3, ""), (4, "hello world"), (5, "zebra one two three four five six")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    rows = decontaminate.find_leaks(odd, bench).collect()
    # "hello world" has fewer than five words and is found verbatim.
    assert sorted((r.doc_id, r.item_id or 0) for r in rows) == [(1, 0), (1, 1), (1, 1), (3, 4), (3, 4)]
    assert decontaminate.find_leaks(empty, bench).count() == 0 and decontaminate.find_leaks(odd, bench.limit(0)).count() == 0
    kept = decontaminate.drop_contaminated(odd, bench)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 3


def test_decontamination_holds_no_documents_beside_the_search(spark, empty):
    """Beside a column function an executor holds the rows of a batch, texts and all, until it has answered."""
    docs = spark.createDataFrame([(1, "Hello, wide world!"), (None, "hello hello wide world"), (1, "Hello, wide world!"), (2, None), (3, "")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "hello wide world"), (None, "wide world")], "item_id long, text string")
    found = decontaminate.find_leaks(docs, bench)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan
    assert found.dtypes == [("doc_id", "bigint"), ("item_id", "bigint"), ("item_words", "int"), ("edits", "int"), ("first_word", "int")]
    rows = [(1, 7, 3, 0, 0), (1, None, 2, 0, 1), (None, 7, 3, 0, 1), (None, None, 2, 0, 2)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted([*rows[:2], *rows], key=str)
    assert decontaminate.find_leaks(empty, bench).collect() == []


def brute_parse(text, sample):
    """Phrases of the greedy parse in which each is the longest that occurs in the sample; single letters otherwise."""
    at = n = 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        at, n = end, n + 1
    return n


@settings(max_examples=200, deadline=None)
@given(st.text("abcd", min_size=1, max_size=60), st.lists(st.text("abcde", max_size=80), min_size=1, max_size=6), st.sampled_from([1, 2, 3, 7, 256]))
def test_phrase_counts_equal_brute_force(sample, texts, stretch):
    """Over whole texts, with letters that the sample lacks, whatever the stretch."""
    letters = {c: i + 1 for i, c in enumerate("abcde")}
    table = language.parse_table([letters[c] for c in sample], 6)
    codes = [np.array([letters[c] for c in t], dtype=np.uint8) for t in texts]
    assert language.count_phrases(codes, [table], stretch)[0].tolist() == [brute_parse(t, sample) for t in texts]


def test_language_query_equals_the_brute_parse(spark):
    """Predictions and scores of whole documents, longest ones included, against a parse by substring search."""
    docs = table(spark, SF, "documents")
    model = language.fit_documents(docs)
    rows = {r.doc_id: r for r in registry.op9_language(spark, SF).collect()}
    texts = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: -len(r[1]))
    lookup, other = model.lookup(), len(model.letters) + 1
    picked = language.sample(docs.where(~language.held_out(F.col("doc_id"))))
    samples = ["".join(map(chr, language.sample_codes(picked[name], lookup, other, len(picked)))) for name in model.languages]
    for doc_id, text in texts[:1] + texts[1::40]:
        codes = language.to_codes(text, lookup, other)
        coded = "".join(map(chr, codes))
        if not codes.any():
            assert rows[doc_id].lang_pred == "und"
            continue
        entropy = [brute_parse(coded, s) * np.log2(max(2, len(s))) / len(codes) for s in samples]
        best = int(np.argmin(entropy))
        assert rows[doc_id].lang_pred == model.languages[best]
        assert abs(rows[doc_id].score - (1 - entropy[best] / min(e for i, e in enumerate(entropy) if i != best))) < 1e-9


def test_language_query_is_right_on_held_out_documents(spark):
    lang = {r.doc_id: r.lang for r in table(spark, SF, "documents").collect()}
    rows = registry.op9_language(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(lang)
    held = [r for r in rows if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("entries", [language.TABLE_ENTRIES, 0])
def test_all_languages_and_letters_are_learned(spark, monkeypatch, entries):
    monkeypatch.setattr(language, "TABLE_ENTRIES", entries)
    rng = random.Random(3)
    rows, want = [], {}
    for n in range(70):  # each has 20 letters of its own, the last ones beyond the basic plane
        letters = [chr(c) for c in range(0x4E00 + 20 * n, 0x4E00 + 20 * n + 20)] if n < 65 else [chr(0x20000 + 20 * n + i) for i in range(20)]
        for d in range(6):
            want[len(rows)] = f"l{n:02}"
            rows.append((len(rows), " ".join("".join(rng.choices(letters, k=4)) for _ in range(20)), f"l{n:02}"))
    got = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    learned = {want[d] for d in want if zlib.crc32(str(d).encode()) % 4 != 2}
    assert len(learned) == 70 and {r.doc_id: r.lang_pred for r in got} == want


@settings(max_examples=60, deadline=None)
@given(st.text("abcd", min_size=1, max_size=60), st.lists(st.text("abcde", min_size=1, max_size=80), min_size=1, max_size=6))
def test_sorted_transitions_equal_the_table(sample, texts):
    codes = [ord(c) - 96 for c in sample]
    texts = [np.array([ord(c) - 96 for c in t], np.uint8) for t in texts]
    both = [language.transitions(codes, 6, entries) for entries in (10**6, 0)]
    assert both[0].table is not None and both[1].table is None
    got = language.count_phrases(texts, [language.parse_table(codes, 6), *both]).tolist()
    assert got[0] == got[1] == got[2]


def test_language_of_odd_rows(spark, odd, empty):
    rows = language.identify(odd).collect()
    assert len(rows) == len(ODD)
    assert {r.lang_pred for r in rows if r.doc_id in (7, 8, 9)} == {"und"}
    assert language.identify(empty).count() == 0
    nothing = language.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    kept = language.keep_known(odd)
    assert kept.columns == odd.columns and kept.count() == 6
    assert {r.lang for r in kept.collect()} <= {"en", "fr"}
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1  # texts are parsed once
    assert language.keep_known(empty).count() == 0 and language.keep_known(odd.drop("lang"), language.fit_documents(odd)).count() == 6


@pytest.mark.parametrize("size", [1, 7, 50])
def test_long_texts_in_pieces_are_the_same(monkeypatch, size):
    from rasterloom.llm import near_dedup

    text = "the quick  brown\nfox's <|endoftext|> jümps  over \n\n the lazy dog " * 5 + "x" * 90
    items = [(1, "the quick brown fox s endoftext jümps over the lazy dog the")]
    index = decontaminate.build_index(items, 0.8, 0.99, 7)
    lookup = np.array([2 if chr(c).isalpha() else 0 for c in range(1 << 16)], dtype=np.uint8)

    def all_of():
        words = decontaminate.word_ids(text, index.vocabulary)
        return (OWN.encode([text])[0], near_dedup.simhash(text), language.to_codes(text, lookup, 2).tolist(), words.tolist(), decontaminate.search(index, index.bags(), index.masks(), index.bands(), [words]))

    whole = all_of()
    monkeypatch.setattr(encoding, "PIECE_CHARS", size)
    assert "".join(encoding.pieces(text)) == text and len(list(encoding.pieces(text))) > 3
    assert all_of() == whole and whole[4][0]
