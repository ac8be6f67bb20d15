"""Each operator against brute force, round trips or planted cases; nulls, empty tables, ties, clashing columns."""

import random
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest

from scriptoria.llm import encodings, groups, leaks, near_duplicates, packing, repetition, scan_noise, spam
from scriptoria.session import Scratch

REVIEW = "question_id string, duplicate_of_question_id string, rid bigint, v string"
TEXTS = "question_id string, question_text string, options array<struct<label:string,text:string>>, h bigint"
WORDS = [f"w{i}x" for i in range(400)]


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


# problem 1


def brute_repeats(text, labels):
    w, seen, cover = words(text), set(), set()
    for i in range(len(w) - 4):
        run = tuple(w[i : i + 5])
        if run in seen:
            cover |= set(range(i, i + 5))
        seen.add(run)
    keys = [k for k in ("".join(words(unicodedata.normalize("NFKC", x))) for x in labels if x) if k]
    return len(w) >= 10 and len(cover) >= 0.3 * len(w) or len(set(keys)) < len(keys)


def test_repetition_agrees_with_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        s = sentence(rng, rng.randint(3, 60))
        if i % 4 == 0:
            part = s.split()
            k = rng.randint(1, len(part))
            s += " " + " ".join(part[:k]).upper()
        labels = ["a", "b", "c"] + ([rng.choice(["A)", "ａ", " b", "d", "--", None])] if i % 5 == 0 else [])
        rows.append((f"q{i}", s, [(x, "t") for x in labels], i))
    rows += [("null", None, None, 0), ("empty", "", [], 0), ("blank", "  ", [(None, None), (None, None), ("-", ""), ("-", "")], 0), ("long", "the same five words again " * 20000, None, 0), (None, "x " * 50, None, 0)]
    rows.append(rows[0])
    got = {r.question_id for r in repetition.repeating_records(spark.createDataFrame(rows, TEXTS)).collect()}
    assert got == {q for q, t, o, _ in rows if q is not None and brute_repeats(t, [x for x, _ in o or []])}


def test_shares_of_all_records(spark):
    run = "one two three four five"
    rows = [(f"q{i}", f"{run} {' '.join(WORDS[:n])} {run}", None, 0) for i, n in enumerate((0, 10, 40, 390))]
    rows += [("none", " ".join(WORDS), None, 0), ("short", "x y x y x", None, 0), ("null", None, None, 0), (None, f"{run} {run}", None, 0)]
    df = spark.createDataFrame([*rows, rows[0]], TEXTS)
    expected = {"q0": 0.5, "q1": 0.25, "q2": 0.1, "q3": 0.0125, "none": 0.0, "short": 0.0, "null": 0.0}
    shares = repetition.repeated_shares(df).collect()
    assert len(shares) == len(expected) and {r.question_id: r.repeated_share for r in shares} == pytest.approx(expected)
    model = repetition.Model(np.zeros(repetition.PLAIN + repetition.AGAIN + 1), -30.0, 1.0, 0.0)  # every record below the threshold
    assert {r.question_id: r.repeated_share for r in repetition.measure_repetition(df.filter("question_id is not null"), model).collect()} == pytest.approx(expected)
    assert {r.question_id for r in repetition.repeating_records(df).collect()} == {"q0"}


def test_repetition_of_an_empty_table(spark):
    assert repetition.repeating_records(spark.createDataFrame([], TEXTS)).count() == 0


def test_the_classifier_selects(spark):
    rng = random.Random(15)
    rows = []
    for i in range(2000):
        s = sentence(rng, rng.randint(12, 60)).split()
        if i % 25 == 0:
            n = rng.randint(5, len(s))
            s += s[:n]
        rows.append((f"q{i}", " ".join(s), [(x, "t") for x in ("a", "b", "c", "d")] + ([("B.", "t")] if i % 40 == 1 else []), i))
    df = spark.createDataFrame(rows, TEXTS)
    model = repetition.fit_model(df, "question_id", "question_text")
    out = repetition.measure_repetition(df, model).collect()
    odd = spark.createDataFrame([(f"o{x}", rows[1][1], [("a", "t"), (x, "t"), (f" {x.upper()})", "t")], 0) for x in ("f", "g", "z", "9", "iv", "10", "أ", "ж")], TEXTS)
    assert all(r.probability >= repetition.THRESHOLD for r in repetition.measure_repetition(odd, model).collect())
    true = {q for q, t, o, _ in rows if brute_repeats(t, [x for x, _ in o])}
    chosen = {r.question_id for r in out if r.probability >= repetition.THRESHOLD}
    assert true <= chosen and len(chosen) < 2 * len(true)
    assert model.held["recall"] == 1.0 and model.held["candidates"] < 0.2
    for _, n, said, found in model.held["bins"]:
        assert n < 40 or abs(said - found) < 0.1
    model.weights[:] = 0
    assert len({r.probability for r in repetition.measure_repetition(df, model).collect()}) == 1


# problem 3


def brute_groups(rows):
    key = lambda x: (x or "").strip().lower()
    ids = {key(q): q for q, *_ in rows if key(q)}
    parent = {k: k for k in ids}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    linked = set()
    for q, d, *_ in rows:
        a, b = key(q), key(d)
        if a in ids and b in ids and a != b:
            linked |= {a, b}
            parent[find(a)] = find(b)
    members = defaultdict(list)
    for k in linked:
        members[find(k)].append(ids[k])
    return {(ids[k], min(members[find(k)])) for k in linked}


def test_groups_of_chains_stars_cycles_and_dangling(spark):
    rows = [(f"c{i:03}", f" C{i + 1:03} ", 1, "x") for i in range(60)]
    rows += [(f"s{i}", "s0", 1, "x") for i in range(1, 40)] + [("s0", None, 1, "x"), ("loop1", "loop2", 1, "x"), ("loop2", "loop1", 1, "x")]
    rows += [("own", "own", 1, "x"), ("lost1", "gone", 1, "x"), ("lost2", "gone", 1, "x"), ("blank", "  ", 1, "x"), (None, "s0", 1, "x"), ("", "s0", 1, "x")]
    rows.append(rows[0])
    got = {(r.question_id, r.group_id) for r in groups.duplicate_groups(spark.createDataFrame(rows, REVIEW), Scratch(spark, "t3")).collect()}
    assert got == brute_groups(rows)


def test_groups_of_an_empty_table(spark):
    assert groups.duplicate_groups(spark.createDataFrame([], REVIEW), Scratch(spark, "t3")).count() == 0


# problem 4


def brute_pairs(rows):
    runs = [(q, set(zip(w, w[1:], w[2:]))) for q, t, *_ in {r[:2] for r in rows} if q is not None for w in [words(t)]]
    out = set()
    for i, (p, x) in enumerate(runs):
        for q, y in runs[:i]:
            if p != q and x and y and 2 * len(x & y) >= len(x | y):
                out.add((min(p, q), max(p, q)))
    return out


def edited(rng, s, n):
    w = s.split()
    for _ in range(n):
        i = rng.randrange(len(w))
        w[i : i + rng.randint(0, 1)] = [rng.choice(WORDS)] * rng.randint(0, 1)
    return " ".join(w) or "x"


@pytest.mark.parametrize("seed", [3, 4])
def test_near_duplicates_lose_no_pair(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        s = sentence(rng, rng.choice([3, 4, 5, 8, 15, 30, 60]))
        rows += [(f"q{i}-{j}", edited(rng, s, j), None, 0) for j in range(rng.randint(1, 7))]
    common = sentence(rng, 12)
    rows += [(f"t{i}", f"{common} {sentence(rng, 10)}", None, 0) for i in range(30)]
    rows += [(f"copy{i}", "One text, word for WORD the same.", None, 0) for i in range(4)] + [("two", "two words", None, 0), ("none", None, None, 0), ("empty", "", None, 0), (None, "One text, word for word the same", None, 0)]
    rows.append(rows[0])
    rows.append(("long", "a b c d e f g " * 3000, None, 0))
    got = {(r.question_id_1, r.question_id_2) for r in near_duplicates.near_duplicate_pairs(spark.createDataFrame([r[:2] + (None, 0) for r in rows], TEXTS), Scratch(spark, "t4")).collect()}
    assert got == brute_pairs(rows)


def test_near_duplicates_of_an_empty_table(spark):
    assert near_duplicates.near_duplicate_pairs(spark.createDataFrame([], TEXTS), Scratch(spark, "t4")).count() == 0


def test_thresholds_reach_the_bound():
    rng = np.random.default_rng(5)
    text = np.sort(rng.integers(0, 30, 200))
    at = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    sizes = rng.integers(1, 4, 200)
    begin = np.cumsum(sizes) - sizes
    cost = np.concatenate([np.sort(rng.integers(1, 100, n)) for n in sizes]).astype(float)
    need = np.bincount(text, sizes, minlength=30).astype(int) // 3 + 1
    gain = near_duplicates._thresholds(need, text, begin, sizes, cost, cost[begin])
    assert (gain <= sizes).all() and (np.bincount(text, gain, minlength=30)[text[at]] == need[text[at]]).all()


# problem 6


def test_editor_repairs_what_it_was_not_shown():
    rng = random.Random(6)
    syllables = ["tra", "me", "lon", "gi", "sta", "ber", "cu", "di", "ser", "no", "fa", "pli"]
    vocabulary = sorted({"".join(rng.choice(syllables) for _ in range(4)) for _ in range(600)})
    cells = np.zeros((2, 1 << scan_noise.CELL_BITS), np.int64)
    import xxhash

    for w in vocabulary:
        h = xxhash.xxh64_intdigest(w)
        cells[0][h & (len(cells[0]) - 1)] += 40
        cells[1][(h >> 32) & (len(cells[0]) - 1)] += 40
    lexicon = scan_noise.Lexicon(cells)
    reader = scan_noise.Reader(scan_noise.Editor.train(vocabulary[:300], lexicon), lexicon)
    held = vocabulary[300:]
    assert all(reader.word(w) == w for w in held)
    spoiled = [(w.replace("e", "c", 1), w) for w in held if "e" in w] + [(w.replace("o", "0", 1), w) for w in held if "o" in w]
    spoiled += [(w.replace("n", "ri", 1), w) for w in held if "n" in w]
    assert sum(reader.word(a) == b for a, b in spoiled) > 0.97 * len(spoiled)
    first, second = held[0], held[1]
    assert reader.judge(f"{first[:4]}-\n{first[4:]} {second}") == (0, True)
    assert reader.judge(f"{first}-{second}")[1] is False
    idle = scan_noise.Reader(scan_noise.Editor(), lexicon)  # without weights nothing is read or joined
    assert all(idle.word(a) == a for a, _ in spoiled) and idle.judge(f"{first[:4]}-\n{first[4:]} {second}") == (0, False)


def test_page_lines_and_header_keys():
    pages = [[f"the wall of part {'abcdefgh'[d % 8]} and more\n" * 12 for _ in range(6)] for d in range(60)]
    model = scan_noise.Furniture.train(pages, ["wall", "lobe", "tract", "sheath", "ridge", "border"])
    edge = lambda s: model.is_number(s, 0, 20, True)
    assert all(map(edge, ("12 | Page", "Page 3 of 10", "- 7 -", "[12]", "~ 4 ~", "p. 45", "88", "xxiv", "SEITE 7", "página 12")))
    assert not any(map(edge, ("1 4 2", "±2", "37 °C", "a- 12", "12- The", "L4.", "mix", "Page", "12345")))
    assert not model.is_number("88", 9, 20, True) and not model.is_number("88", 0, 1, False)
    head = lambda **x: model.score(model.header_features(**{"pages": 6, "doc_pages": 7, "top": 6, "bottom": 0, "forms": 3, "numbered": 2, "letters": 14, "others": 0.0} | x)) > 0
    assert head() and head(others=0.004) and not head(others=0.3, forms=1, numbered=0, pages=3, top=2, bottom=1, letters=4)
    model.weights = {}
    assert not edge("Page 3 of 10") and not head()
    assert scan_noise.line_key("10  Notes on P0ndnioron Bunsceloid Lesion")[0] == scan_noise.line_key("NOTES ON PONDNIORON BURISCELOID LESION")[0]
    rng = random.Random(16)
    assert all(scan_noise.page_shape(scan_noise.page_form(rng, p)) for p in range(1, 400))


def test_scan_noise_finds_furniture_and_takes_nulls(spark):
    pages = [("D1", i, f"Notes on Gavusine Branch {i + 3}\nsome page text of number {chr(97 + i) * 5}\nmore of it\n- {i + 3} -", "x") for i in range(5)]
    pages += [("D1", 9, None, "x"), (None, 1, "a", "x"), ("D2", 1, "", "x"), ("D2", None, "b", "x")] + [pages[0]]
    review = [("q1", " d1", "What is the\nNotes on Gavusine Branch\nbranch for?"), ("q2", "D2", "What is it?"), ("q3", None, None), (None, "D1", "x")]
    p = spark.createDataFrame(pages, "document_id string, page int, text string, table_name string")
    q = spark.createDataFrame(review, "question_id string, document_id string, question_text string")
    got = {tuple(r) for r in scan_noise.scan_noise(p, q, Scratch(spark, "t6")).collect()}
    assert got == {("page_extractions", f"D1#{i}", k) for i in range(5) for k in ("header", "pageno")} | {("needs_review", "q1", "header")}
    assert scan_noise.scan_noise(p.limit(0), q.limit(0), Scratch(spark, "t6")).count() == 0


def test_repaired_texts_hold_no_header_that_was_found(spark):
    pages = [("D1", i, f"Review of Gavusine Branch {i + 3}\nsome page text of number {chr(97 + i) * 5}\nmore of it\n- {i + 3} -") for i in range(5)]
    review = [
        ("q1", " d1", "The smooth Review of Gavusine Branch groove limits what?"),
        ("q2", "D1", "The wall\nREVIEW OF GAVUSINE BRANCH is covered by 3 of\n- 7 -\nwhat at 37 degrees?"),
        ("q3", "D1", "Which wall is Revicw  of Gavus1ne Branch 12\nthe first?"),
        ("q4", "D1", "Review of Gavusine Branch"),
        ("q5", "D1", "Review of what?"),
    ]
    p = spark.createDataFrame(pages, "document_id string, page int, text string")
    q = spark.createDataFrame(review, "question_id string, document_id string, question_text string")
    found = {r.record_key for r in scan_noise.scan_noise(p, q, Scratch(spark, "t6")).collect() if r.noise_kind == "header"}
    got = {r.record_key: r.repaired_text for r in scan_noise.repaired_texts(p, q, Scratch(spark, "t6r")).collect()}
    head = scan_noise.line_key("Review of Gavusine Branch")[0]
    assert found == set(got) - {"q5"} and not any(head in scan_noise.fold(t) for t in got.values())
    assert {k: t for k, t in got.items() if k[0] == "q"} == {
        "q1": "The smooth groove limits what?", "q2": "The wall is covered by 3 of what at 37 degrees?", "q3": "Which wall is the first?", "q4": "", "q5": "Review of what?",
    }


# problem 7

RIGHT = ["La fièvre à côté de la crête s'élève “ici”.", "Der Fuß führt über die Öffnung, mäßig – größer.", "Un niño pequeño más allá de la lesión", "ثقب الطرف على عند القطخ", "37 °C ±2 µm"]


@pytest.mark.parametrize("codec", ["cp1252", "cp437", "cp850", "cp1251", "mac_roman", "latin-1"])
@pytest.mark.parametrize("text", RIGHT)
def test_wrong_decodings_are_undone(text, codec):
    try:
        wrong = text.encode().decode(codec)
    except UnicodeDecodeError:
        pytest.skip("the codec has no character for a byte")
    r = encodings.repair("Right text before. " + wrong)
    assert r.garbled and r.text == "Right text before. " + text


@pytest.mark.parametrize("text", RIGHT + ["NÃO", "São naïve", "CAFÉ » et « ÉTÉ »", "l’été", "β-type", "■☃○♦│¤ a■b│¤c", "\x01\x02", "llllll", "", "МОСКВА Привет, ёлка", "Γ is a letter"])
def test_right_text_stays(text):
    r = encodings.repair(text)
    assert not r.garbled and r.text == text


def test_twice_wrong_single_byte_and_lost():
    text = "Größe über schützt"
    assert encodings.repair(text.encode().decode("cp1252").encode().decode("cp1252")).text == text
    arabic = "ثقب الطرف على القطخ"
    assert encodings.repair(arabic.encode("cp1256").decode("cp1252")).text == arabic
    assert encodings.repair("la cr�te").garbled and encodings.repair(None).text == ""


@pytest.mark.parametrize("text", ["Państwo w tej części świata", "Český jazyk je těžký, kůže", "Ні, це не так", "a 10 kΩ resistor and 5 μmol/L", "sinθ + cosθ and a πbond", "Größe Maß\xad\nstab “groß“"])
def test_right_words_stay_whatever_the_corpus_has(text):
    known = {"größe": 40, "fièvre": 40, "niño": 60, "crête": 30}
    r = encodings.repair(text, lambda w: known.get(w, 0))
    assert not r.garbled and r.text == text


@pytest.mark.parametrize("codec", ["cp1250", "cp1251", "cp1257"])
@pytest.mark.parametrize("text", ["La fièvre à côté de la crête était aiguë, la cône aussi", "El niño más pequeño según el corazón", "Der größere Fuß führt über die mäßige Öffnung"])
def test_western_words_are_told_by_the_corpus(text, codec):
    known = Counter(re.findall(r"[^\W\d_]+", text.lower()))
    del known["cône"], known["corazón"], known["öffnung"]
    wrong = text.encode("cp1252").decode(codec, "replace")
    r = encodings.repair(wrong, lambda w: 20 * known[w])
    assert r.text == text if "�" not in wrong else r.garbled


@pytest.mark.parametrize("text", ["שלום עולם", "東京都の人口", "한국어 문장", "😀 and 😷", "नमस्ते"])
@pytest.mark.parametrize("codec", ["cp1252", "latin-1"])
def test_other_scripts_and_signs_are_restored(text, codec):
    wrong = "".join(bytes([b]).decode("cp1252") if codec == "cp1252" and b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in text.encode())
    assert encodings.repair("Before: " + wrong).text == "Before: " + text


def test_many_layers_are_undone():
    text, wrong = "Größe", "Größe"
    for _ in range(7):
        wrong = "".join(bytes([b]).decode("cp1252") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in wrong.encode())
    assert encodings.repair(wrong).text == text


def test_repair_pages_takes_nulls_and_clashes(spark):
    rows = [("d", 1, "FuÃŸ", True), ("d", 1, "FuÃŸ", True), ("d", 2, None, False), (None, 3, "FuÃŸ", True), ("d", 4, "right", None)]
    df = spark.createDataFrame(rows, "document_id string, page int, text string, garbled boolean")
    assert [tuple(r) for r in encodings.garbled_keys(df).collect()] == [("d", 1)]
    assert encodings.garbled_keys(df.limit(0)).count() == 0


# problem 8


def check_packing(rows, capacity):
    room, pieces = defaultdict(int), defaultdict(list)
    for r in rows:
        if r.tokens:
            room[r.container] += r.tokens
            pieces[r.doc_id].append(r)
        else:
            assert r.container is None
    assert max(room.values()) <= capacity and set(room) == set(range(len(room)))
    for parts in pieces.values():
        assert len(parts) == -(-sum(p.tokens for p in parts) // capacity)
    return sum(room.values()), len(room)


def test_packing_fills_containers(spark):
    rng = random.Random(8)
    rows = [(i, sentence(rng, max(1, int(rng.lognormvariate(5, 1.2)))), 1) for i in range(1500)]
    rows += [(-1, None, 1), (-2, "", 1), (-3, "word " * 9000, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, part int").repartition(5)
    out = packing.pack(df, Scratch(spark, "t8")).collect()
    assert {r.doc_id for r in out} == {r[0] for r in rows}
    tokens, containers = check_packing(out, packing.CAPACITY)
    assert tokens / (containers * packing.CAPACITY) > 0.95
    assert packing.pack(df.limit(0), Scratch(spark, "t8")).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_item_once(seed):
    rng = random.Random(seed)
    hist = {s: rng.randint(1, 50) for s in rng.sample(range(1, 65), 30)}
    plan = packing.make_plan(hist, 64).frozen()
    room = defaultdict(int)
    for s, n in hist.items():
        ranks, first, per = plan[s]
        for r in range(n):
            k = int(np.searchsorted(ranks, r, "right")) - 1
            room[first[k] + (r - ranks[k]) // per[k]] += s
    assert max(room.values()) <= 64 and len(room) <= 1.25 * (sum(s * n for s, n in hist.items()) / 64) + 3


# problem 9


def brute_leaks(docs, items, n=12):
    where = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(len(w) - n + 1):
            where[tuple(w[k : k + n])].add(i)
    return {(d, i) for d, t in docs for w in [words(t)] for k in range(len(w) - n + 1) for i in where.get(tuple(w[k : k + n]), ())}


@pytest.mark.parametrize("block", [leaks.BLOCK_CHARS, 900])
def test_leaks_agree_with_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(leaks, "BLOCK_CHARS", block)
    rng = random.Random(9)
    items = [(i, sentence(rng, rng.randint(5, 50))) for i in range(60)] + [(100, None), (None, sentence(rng, 20)), (101, "")]
    items.append((200, items[0][1]))
    docs = []
    for d in range(200):
        parts = [sentence(rng, rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            w = rng.choice(items[:60])[1].split()
            n = rng.choice([10, 11, 12, 13, 30])
            k = rng.randrange(max(1, len(w) - n + 1))
            parts += [rng.choice([", ", "\n\n", "; "]).join(w[k : k + n]).upper(), sentence(rng, rng.randint(0, 9))]
        docs.append((d, ". ".join(parts)))
    docs += [(1000, None), (1001, ""), (None, items[0][1]), (1002, items[1][1] + " " + "z " * 20000 + items[2][1])]
    docs.append(docs[0])
    a = spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, text string, item_id int")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.leaked_items(a, b).collect()}
    assert got == brute_leaks([d for d in docs if d[0] is not None], [i for i in items if i[0] is not None])
    assert leaks.leaked_items(a, b.limit(0)).count() == 0 and leaks.leaked_items(a.limit(0), b).count() == 0


def test_leaks_with_edits(spark):
    rng = random.Random(10)
    w = sentence(rng, 30).split()
    changed = w[:6] + [w[6] + "s"] + w[7:14]
    a = spark.createDataFrame([(1, " ".join(changed)), (2, " ".join(w[:8]))], "doc_id bigint, text string")
    b = spark.createDataFrame([(5, " ".join(w))], "item_id bigint, text string")
    assert leaks.leaked_items(a, b, edits=0).count() == 0
    assert [(r.doc_id, r.item_id) for r in leaks.leaked_items(a, b, edits=2).collect()] == [(1, 5)]


def test_leaks_with_edits_at_every_word():
    rng = random.Random(14)
    long, short = sentence(rng, 12).split(), "a b c d e f g h i j k l".split()
    changes = {"first": lambda w: "ß" + w[1:], "last": lambda w: w[:-1] + "ß", "more": lambda w: w + "ß", "less": lambda w: w[1:] or "ß"}
    for item in (long, short):
        indexes = leaks.build_indexes([(5, " ".join(item))], 2)
        for one in range(12):
            for two in range(one, 12):
                for change in changes.values():
                    w = list(item)
                    for k in {one, two}:
                        w[k] = change(w[k])
                    t = leaks._norm(f"before {' '.join(w)} after")
                    codes = leaks._codes(t)
                    found = [n for x in indexes for _, _, n in leaks.find_leaks(codes, np.zeros(len(t), np.int32), np.array([0, len(t)]), x, 2)]
                    assert found == [12], (w, found)
        w = [changes["first"](x) if k in (1, 5, 9) else x for k, x in enumerate(item)]
        t = leaks._norm(" ".join(w))
        assert not [n for x in indexes for n in leaks.find_leaks(leaks._codes(t), np.zeros(len(t), np.int32), np.array([0, len(t)]), x, 2)]


# problem 10


def test_automaton_agrees_with_brute_force():
    rng = random.Random(12)
    for _ in range(40):
        t = [rng.choice("abcd") for _ in range(rng.randint(1, 30))]
        runs = defaultdict(int)
        for i in range(len(t)):
            for j in range(i + 1, len(t) + 1):
                runs[tuple(t[i:j])] += 1
        expected = [max((n for n in range(1, i + 2) if runs[tuple(t[i + 1 - n : i + 1])] > 1), default=0) for i in range(len(t))]
        assert spam.repeated(t) == expected


CONTENT = "The primary ridge of the lobe depends on the plexus. A wall is covered by the membrane, which joins the sheath.\n"


@pytest.mark.parametrize(
    ("text", "is_spam"),
    [
        (CONTENT * 3, False),
        (CONTENT + "Keywords: " + ", ".join(f"term{i} notes exam" for i in range(60)), True),
        (CONTENT * 12 + "Tags: free notes, exam pack, best pdf, free app", False),
        ("\n".join(f"https://site{i}.example/free-{i}?id={i}" for i in range(30)), True),
        ("\n".join(f"See http://site{i}.example/a for the wall of the lobe in the sheath." for i in range(8)), False),
        ("\n".join(f'<a href="http://site{i % 7}.example/exam-{i}">{("lobe", "wall", "duct")[i % 3]} notes</a>' for i in range(30)), True),
        ("\n".join(f'<a href="http://site{i}.example/{i}">The wall of the lobe is covered by the sheath</a>' for i in range(8)), False),
        ("\n".join(f"<p>The wall of the lobe is joined by <b>one sheath</b> with the duct {i}.</p>" for i in range(8)), False),
        (" > ".join(f"Shop word{i}" for i in range(40)), True),
        ("\n".join(f"Pack {i} cards | A5 | {i}.99 | in stock" for i in range(20)), True),
        (" ".join(f"Best lobe {a} {b}." for a in ("free", "cheap", "exam") for b in ("pdf", "app", "free", "exam", "pack")), True),
        ("#a1 #b2 #a1 #c3 #a1 #b2 " * 10, True),
        ("Model answers\n" + " ".join(f"{i}-{'abcd'[i % 4]}" for i in range(200)), False),
        ("Contents\n" + "\n".join(f"Chapter {i}. The wall of the lobe ........ {i * 3}" for i in range(20)), False),
        (None, False), ("", False), ("word", False), (" \n ", False),
    ],
)
def test_spam(text, is_spam):
    words_, spam_words, _ = spam.page_measures(text)
    assert (spam_words > 0.5 * words_) == is_spam


@pytest.mark.parametrize(
    "text",
    [
        "Fever, cough, headache, nausea, vomiting, chills, fatigue, rash",
        "Aspirin | 300 mg | oral\nHeparin | 5000 units | subcutaneous\nInsulin | 10 drops | nasal",
        "Smith, Nerves; Jones, Vessels; Brown, Joints, see https://library.example/anatomy",
    ],
)
def test_lists_that_repeat_nothing_are_no_spam(text):
    assert spam.page_measures(text)[1] == 0
    assert spam.page_measures(f"{text}\n{text}")[1] > 0


@pytest.mark.parametrize(
    ("text", "is_spam"),
    [
        ("تحميل ملخص، مراجعة مجانية، تحميل ملخص، اختبار محلول، مراجعة مجانية، تحميل ملخص، اختبار محلول", True),
        ("leçon pdf, résumé gratuit, leçon pdf, télécharger médecine, résumé gratuit, leçon pdf", True),
        ("Prüfung • Lösung • Prüfung • Skript • Prüfung • Lösung • Prüfung • Skript", True),
        ("Home\nProducts\nLogin\n" * 3, True),
        ("pdf\nnotes\nexam\npdf\nexam\nnotes\npdf\nexam\n" * 2, True),
        ("a\nb\nc\na\nb\nd\na\n" * 3, False),
        ("12\n14\n12\n14\n" * 3, False),
        ("Fièvre\nToux\nNausée\nCéphalée\nÉruption", False),
        ("تقع العضلة على السطح الداخلي من العظم. يمر العصب من خلال القناة في الجدار.\n" * 3, False),
        ("La fièvre dépend de la lésion profonde. Une artère traverse la paroi près de la crête.\n" * 3, False),
    ],
)
def test_spam_of_every_language_and_of_short_lines(text, is_spam):
    words_, spam_words, _ = spam.page_measures(text)
    assert (spam_words > 0.5 * words_) == is_spam


def test_long_texts_do_not_repeat_by_chance():
    rng = random.Random(13)
    letters = [f"{a}{b}{c}" for a in "ابتثج" for b in "حخدذرزس" for c in "شصضطظعغفقك"]
    text = "\n".join(" ".join(rng.choice(letters) for _ in range(7)) for _ in range(1200))
    words_, spam_words, _ = spam.page_measures(text)
    assert spam_words <= 0.5 * words_
    words_, spam_words, _ = spam.page_measures(text + "\n" + text)
    assert spam_words > 0.5 * words_


def test_function_words_come_from_the_corpus(spark):
    rng = random.Random(14)
    nouns, glue = [f"no{i}me" for i in range(300)], ["della", "alla", "che", "nel"]
    page = lambda: ". ".join(" ".join(f"{rng.choice(nouns)} {rng.choice(glue)}" for _ in range(5)) for _ in range(12)) + "."
    pages = [page() for _ in range(300)]
    pile = ", ".join(rng.choice(nouns[:12]) for _ in range(200))
    said = pages[0] * 3
    docs = [(i, t, "it") for i, t in enumerate(pages)] + [(900, said, "it"), (901, pile, "it"), (902, pile, None), (903, None, "it")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    assert spam.common_words(df)["it"] == set(glue)
    assert {r.doc_id for r in spam.spam_pages(df).filter("is_spam").collect()} == {901, 902}


def test_spam_pages_takes_nulls_and_clashes(spark):
    rows = [(1, None, True), (None, "x", True), (2, "free notes, " * 50, False), (2, "free notes, " * 50, False)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, is_spam boolean")
    out = spam.spam_pages(df)
    assert out.count() == 4 and {r.doc_id for r in out.filter("is_spam").collect()} == {2}
    assert spam.spam_pages(df.limit(0)).count() == 0
