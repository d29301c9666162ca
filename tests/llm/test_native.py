"""Decontamination, personal data and chat formatting against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import chat, decontam, pii, queries

ITEM = ("Anna has 5 apples and gives 2 apples to Bob who already owns 7 kg of pears, "
        "so how many are left")


def items(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def held(df):
    return {(r["doc_id"], r["item_id"]): r for r in df.collect()}


def test_templates_find_other_parameters(spark, frame):
    other = ITEM.replace("Anna", "Carl").replace("Bob", "Dora").replace("5", "19").replace("2", "3.5")
    docs = frame([
        f"before, {ITEM}. After", f"Text in front. So then {other}! And text behind.",
        ITEM.replace(" ", "\n").upper().lower(), "Anna has 5 apples and", None, "", "no match " * 50,
        # Two values for one slot: no consistent reading.
        ITEM.replace("2 apples to Bob who already owns 7", "2 pears to Bob who seldom eats 7")])
    got = held(decontam.contaminated(docs, items(spark, ITEM, None, "", "1 2 3 4 5 6 7")))
    assert set(got) == {(0, 0), (1, 0), (2, 0)}
    assert not got[0, 0]["reparameterised"] and got[1, 0]["reparameterised"]
    assert got[0, 0]["coverage"] == 1 and got[1, 0]["windows"] == got[1, 0]["matched"]


def test_slots_must_be_consistent(spark, frame):
    item = "first Anna walked home then Anna called Anna again while Anna slept over there"
    same = item.replace("Anna", "Zoe")
    mixed = item.replace("Anna", "Zoe", 1).replace("Anna", "Kim", 1).replace("Anna", "Eve", 1)
    got = held(decontam.contaminated(frame([same, mixed]), items(spark, item)))
    assert set(got) == {(0, 0)}


def test_verbatim_items_of_names_are_found(spark, frame):
    known = ["The capital cities are Paris, London, Berlin, Madrid, Rome, Vienna",
             "Which of Newton, Einstein, Curie, Darwin, Galilei first wrote about the tides of our moon",
             "nenne alle Dinge wie Tisch Stuhl Lampe Schrank Regal Teppich"]
    docs = frame([f"Some words before. {k}. Some words behind" for k in known] + [
        "The capital cities are many and none of them is named", "Paris, London, Berlin, Madrid, Rome, Vienna"])
    got = held(decontam.contaminated(docs, items(spark, *known)))
    assert set(got) == {(0, 0), (1, 1), (2, 2)}
    assert all(r["coverage"] == 1 and not r["reparameterised"] for r in got.values())


def test_verbatim_items_are_found_in_any_case_and_without_signs(spark, frame):
    known = [ITEM, "The tank holds 40 l and a car needs 7 l per 100 km. How far, in km, does Eve get? She starts at 5. "
             "Days later Bob drives 30 miles. Then 12 kg of coal are loaded in 3 hours"]
    forms = [str.title, str.upper, str.lower, lambda t: re.sub("[.,]", "", t), lambda t: re.sub("[.,?]", "", t.title())]
    docs = frame([f"Plain words here {form(k)} and plain words there" for k in known for form in forms])
    got = held(decontam.contaminated(docs, items(spark, *known)))
    assert set(got) == {(len(forms) * i + f, i) for i in range(len(known)) for f in range(len(forms))}
    assert all(r["coverage"] == 1 for r in got.values())


def test_items_of_numbers_are_found_in_full(spark, frame):
    known = ["Add 12, 7, 3, 5 and 2", "Compute 12 + 7 * 3 - 5 / 2 =", "Add 12, 7, 3, 5 and 4", "1 2 3 4"]
    docs = frame([f"Now: {known[0]}. And on", f"so compute 12 + 7 * 3 - 5 / 2 = what? {known[1]}",
                  "Add 12, 7, 3, 5", "add 9, 7, 3, 5 and 2", "1 2 3 4 5 6", None, known[0].upper()])
    got = held(decontam.contaminated(docs, items(spark, *known, ITEM)))
    assert set(got) == {(0, 0), (1, 1), (6, 0)}
    assert all((r["matched"], r["windows"], r["coverage"], r["reparameterised"]) == (1, 1, 1.0, False)
               for r in got.values())
    kept = decontam.drop_contaminated(docs, items(spark, *known)).collect()
    assert {r["doc_id"] for r in kept} == {2, 3, 4, 5}


def brute_windows(text):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def test_literal_passages_match_brute_force(spark, frame):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(3))
    known = [" ".join(word() for _ in range(rng.randint(4, 30))) for _ in range(12)]
    docs = []
    for _ in range(80):
        words = [word() for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.6:
            own = rng.choice(known).split()
            own = own[: max(1, int(len(own) * rng.choice([0.5, 0.8, 0.9, 1])))]
            at = rng.randint(0, len(words))
            words[at:at] = own
        docs.append(" ".join(words))
    want = set()
    for d, text in enumerate(docs):
        for i, item in enumerate(known):
            own = brute_windows(item)
            if own and len(own & brute_windows(text)) >= 0.8 * len(own):
                want.add((d, i))
    assert set(held(decontam.contaminated(frame(docs), items(spark, *known)))) == want and want


def test_contaminated_rows_go_and_nulls_stay(spark, frame):
    docs = frame([(None, ITEM), (None, "clean"), (1, ITEM), (1, "clean too"), (1, ITEM), (2, None)],
                 item_id=F.lit(1), print=F.lit(2), words=F.lit(3), matched=F.lit(4))
    kept = decontam.drop_contaminated(docs, items(spark, ITEM))
    assert kept.columns == docs.columns
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} == {(None, "clean"), (1, "clean too"), (2, None)}
    assert decontam.drop_contaminated(docs, items(spark)).count() == 6
    assert decontam.drop_contaminated(frame([]), items(spark, ITEM)).count() == 0


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            if {"email": lambda: True, "ip": lambda: all(int(x) < 256 for x in m[0].split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0,
                "phone": lambda: 8 <= len(digits) <= 15}[kind]():
                out.append((kind, m.start(), m.end()))
    return out


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def pii_texts():
    rng = random.Random(1)
    signs = "a1@.+- 9(0)é😀%\n"
    return [None, "", "1.2.3.4.5.6.7.8", "256.1.1.1 001.0.0.255 1.2.3.1000", "a@b.c+d@e.f@g.h",
            "4111 1111 1111 1111", "4111111111111111 4111-1111-1111-1112", "é😀 x@y.zz +1 (234) 567-8901-",
            "1" * 3000, "a" * 3000 + "@", "+1.2.3.4.5.6.7", "x@y.zz " * 700, "1.1.1.1 " * 300,
            *("".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(800))]


def test_base_spans_match_plain_regular_expressions(frame):
    values = pii_texts()
    for row in pii.report(frame(values)).collect():
        spans = plain_spans(values[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(listed(spans).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in PLAIN] == [sum(s[0] == k for s in spans) for k in PLAIN]


def test_contexts_find_unseen_identifiers(frame):
    texts = [f"please call number: +1 555 123 45{i:02d} now" for i in range(10)] + [
        "please call number: 555-98765 now", "the number: 1234567 x", "call number: 12 only"]
    rows = {r["doc_id"]: r for r in pii.report(frame(texts)).collect()}
    assert rows[10]["spans"] == "id:20:29" and rows[10]["n_id"] == 1
    assert rows[11]["spans"] == "" and rows[12]["spans"] == ""
    # A context that mostly leads elsewhere is no evidence.
    rare = texts + ["call number: none"] * 40
    assert all(r["n_id"] == 0 for r in pii.report(frame(rare)).collect())


def test_redaction_replaces_spans_only(frame):
    rows = [(1, "é x@y.zz and 1.2.3.4 end"), (1, "é x@y.zz and 1.2.3.4 end"), (None, "mail a@b.cc"), (2, None),
            (3, "clean"), (None, "+4111111111111111")]
    df = frame(rows, n_chars=F.length("text").cast("long"), kind=F.lit("k"), spans=F.lit(0))
    got = pii.redact(df)
    assert got.columns == df.columns
    assert sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in got.collect()), key=str) == sorted([
        (1, "é <EMAIL> and <IP> end", 22), (1, "é <EMAIL> and <IP> end", 22), (None, "mail <EMAIL>", 12),
        (2, None, None), (3, "clean", 5), (None, "+<CARD>", 7)], key=str)
    assert pii.redact(frame([])).count() == 0 and pii.report(frame([])).count() == 0


SIGNS = ["<", "[", "\\", "|", "/", "s>", "INST]", "<|turn|>", "<|end|>", "\n", "é", "😀", "x", "</s>",
         "[/INST]", "<\\|turn|>", "%0A"]


def test_escaping_is_reversible_and_leaves_no_control_string(one):
    rng = random.Random(5)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 8))) for _ in range(500)]
    escaped = one(chat.escape, texts)
    assert not any(re.search(r"<\||</?s>|\[/?INST\]", t) for t in escaped)
    assert one(chat.restore, escaped) == texts


def messages(spark, conversations=60):
    rng = random.Random(3)
    kinds = ["text", "text", "image", "audio", "document", None, "x|>"]
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(0, 5)):
            parts = [{"type": rng.choice(kinds), "text": "".join(rng.choice(SIGNS) for _ in range(3)),
                      "ref": "r", "width": 600, "height": None, "seconds": 1.5, "pages": 2}
                     if rng.random() < 0.9 else None for _ in range(rng.randint(0, 4))]
            role = rng.choice(["user", "assistant", None, "a\nb%0A", "<|end|>"])
            rows.append((c, t, role, parts if rng.random() < 0.95 else None))
    return rows, spark.createDataFrame(
        rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>").repartition(3)


def plain_message(parts):
    text, number = "", 0
    for p in parts or []:
        if p and p["type"] == "text":
            text += p["text"]
        elif p:
            number += 1
            kind = "file" if p["type"] is None else "".join(c for c in p["type"] if c.isalpha())
            text += f"<|{kind}:{number}|>"
    return text


@pytest.mark.parametrize("block", [256, 2])
def test_formatted_turns_read_back(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    rows, df = messages(spark)
    turns = chat.formatted_turns(df)
    whole = {r["conv_id"]: r for r in chat.assembled(turns).withColumn(
        "turns", chat.parsed(F.col("formatted"))).collect()}
    for c in {r[0] for r in rows}:
        want = [(role or "", plain_message(parts)) for conv, _, role, parts in rows if conv == c]
        assert [(t["role"], t["text"]) for t in whole[c]["turns"]] == want
        assert [m is not None for m in whole[c]["mask"]] == [role == "assistant" for role, _ in want]
    for r in chat.with_offsets(turns).collect():
        assert whole[r["conv_id"]]["formatted"][r["start"]:].startswith(r["segment"])
        assert [a["number"] for a in r["attachments"]] == list(range(1, len(r["attachments"]) + 1))
        if r["attachments"] and r["attachments"][0]["type"] == "image":
            assert r["attachments"][0]["tokens"] == 85 + 170 * 2


def test_chat_digests(spark, tmp_path):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a</s>"), (1, None, "system", None), (None, 0, "assistant", "é"),
            (2, 0, None, ""), (3, 0, "assistant", "x"), (3, 0, "assistant", "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in queries.op4_chat(spark, str(tmp_path)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("system\n\nuser\na</s>\nassistant\nb\n") and got[1]["n_turns"] == 3
    assert (got[1]["loss_chars"], got[1]["loss_sha256"]) == (1, sha("b"))
    assert got[None]["loss_sha256"] == sha("é") and got[2]["loss_chars"] == 0
    assert got[3]["loss_sha256"] == sha("xx") and got[-1]["loss_sha256"] == sha(queries.FORGED)
    empty = spark.createDataFrame([], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    assert chat.digests(chat.assembled(chat.formatted_turns(empty))).count() == 0


def test_native_operators_run_no_python(spark, frame):
    docs = frame([ITEM, "x@y.zz call number: 12345"])
    _, df = messages(spark, 2)
    for plan in (decontam.contaminated(docs, items(spark, ITEM)), pii.report(docs),
                 chat.digests(chat.assembled(chat.formatted_turns(df)))):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", text)


def test_a_text_with_very_many_finds(spark, frame):
    """20,000 addresses and as many other candidates in one text, in a bounded time."""
    import time

    def text(n):
        return " ".join(f"mail to user{i}@example{i % 7}.org or code A-{i:06d}x now" for i in range(n))

    frame_of = {n: frame([(1, text(n))]) for n in (2000, 20000)}
    took = {}
    for n, df in frame_of.items():
        begin = time.time()
        row = pii.report(df).first()
        assert row["n_email"] == n
        clean = pii.redact(df).first()["text"]
        assert clean.count("<EMAIL>") == n and "@" not in clean
        took[n] = time.time() - begin
    assert took[20000] < 90


def test_spans_that_overlap_are_merged_and_contexts_reach_far(spark):
    rows = [("a", 0, 5), ("b", 3, 9), ("c", 9, 12), ("d", 20, 30), ("e", 22, 25), ("f", 29, 31)] + [
        (f"g{i}", 40 + 3 * i, 42 + 3 * i) for i in range(600)]
    df = spark.createDataFrame([(rows,)], "s array<struct<kind:string,start:bigint,end:bigint>>")
    got = [tuple(r) for r in df.select(pii._merged(F.col("s"))).first()[0]]
    assert got == [("a", 0, 9), ("c", 9, 12), ("d", 20, 31), *rows[6:]]
    text = "x" * 2000
    clean = spark.createDataFrame([(text, rows)], "t string, s array<struct<kind:string,start:bigint,end:bigint>>").select(
        pii._replaced(F.col("t"), pii._merged(F.col("s")))).first()[0]
    want, at = "", 0
    for kind, a, b in got:
        want, at = want + text[at:a] + f"<{kind.upper()}>", b
    assert clean == want


def test_other_finds_that_overlap_no_base_find(spark):
    import random

    rng = random.Random(9)
    form = "array<struct<start:bigint,end:bigint,id:int>>"
    rows = []
    for _ in range(30):
        def some(n):
            return sorted((a, a + rng.randint(1, 9), i) for i, a in enumerate(rng.sample(range(3000), n)))
        rows.append((some(rng.choice([1, 5, 300])), some(rng.choice([1, 5, 300]))))
    df = spark.createDataFrame(rows, f"b {form}, o {form}")
    for row in df.select("b", "o", pii._clear(F.col("b"), F.col("o")).alias("c")).collect():
        want = [o for o in row["o"] if not any(b["start"] < o["end"] and o["start"] < b["end"] for b in row["b"])]
        assert sorted(row["c"]) == sorted(want)


def test_items_in_scripts_without_spaces(spark, frame):
    items = {1: "地球から月までの距離は何キロですか", 2: "中国最长的河流是哪一条", 3: "ประเทศไทยมีกี่จังหวัด",
             4: "What is the 东京 tower height"}
    docs = [(n, f"前文 text before。{t}？ and after 后文") for n, t in items.items()]
    docs += [(10, "地球と月は近い"), (11, "中国的河流很多"), (12, "What is the tower"), (13, "東京 only")]
    wanted = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(frame(docs), wanted).collect()}
    assert got == {(n, n) for n in items}


def test_more_items_than_can_be_broadcast(spark, frame, monkeypatch):
    """The same pairs, and no shuffle moves all words of a text beside each of its windows."""
    known = [ITEM, "plain words of another item that is much like the first one here", "Add 12, 7, 3, 5 and 2", None]
    texts = [f"Before. {ITEM.replace('5', '8')} Behind {known[1].upper()}", f"so {known[2]} then {known[2]} and on",
             ITEM, "nothing of them " * 40, None, "Add 12, 7, 3, 5 and 3"]
    want = held(decontam.contaminated(frame(texts), items(spark, *known)))
    assert set(want) == {(0, 0), (0, 1), (1, 2), (2, 0)}
    monkeypatch.setattr(decontam, "fits", lambda df: False, raising=False)
    monkeypatch.setattr(decontam, "small", lambda df: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = decontam.contaminated(frame(texts), items(spark, *known))
        assert held(found) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    shuffled = re.findall(r"\) Exchange *\nInput \[\d+\]: (\[.*\])", plan)
    assert any("slots#" in columns for columns in shuffled) and not any("words#" in c for c in shuffled)


def test_filter_of_hashes_keeps_all_of_them(spark):
    for count in (0, 1, 200_000):
        hashes = spark.range(count).select(F.xxhash64("id").alias("hash"))
        passed = spark.range(2 * 200_000).select("id", F.xxhash64("id").alias("hash")).where(decontam._known(hashes))
        kept, others = passed.where(F.col("id") < count).count(), passed.where(F.col("id") >= count).count()
        assert kept == count and others < 6_000
