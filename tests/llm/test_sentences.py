import os
import random
from collections import Counter

import pytest

from quarterline.llm import boundaries
from quarterline.llm.boundaries import Model, blocks, count_text, is_folded, is_prose, pairs, sentences
from quarterline.llm.sentences import sentence_spans, train

POOLS = (
    ["The plant stood still.", "No change was seen.", "Dr. Weber approved rows 3 to 9.", "Nobody objected, e.g. for a missing value.", "The feed was late!", "Is it real?",
     "Yes.", "Dr. Adam left at 5 p.m. on Friday.", "The desk closed the ticket at 5 p.m.", "Most rows were kept, i.e. the older ones.", "The memo has gone.", "It closed on Apr. 10.", "He said so, cf. p. 12 of the guide."],
    ["ระบบโหลดข้อมูลแล้ว", "ค่าใหม่สูงขึ้น", "ยังมีแถวอื่น ๆ อีก 5 แถว", "ผู้ตรวจสอบยืนยันค่า"],
    ["यह संभव नहीं!", "कोई बदलाव नहीं।", "मान क्यों नहीं है?"],
    ["መረጃው ትክክል አይደለም።", "ለምን ጠፋ?", "ገቢው ጨመረ።"],
)


@pytest.fixture(scope="module")
def model():
    rng, counts = random.Random(5), Counter()
    for k in range(1200):
        pool = POOLS[0] if k % 2 else POOLS[1 + k // 2 % 3]
        count_text("\n\n".join(" ".join(rng.choices(pool, k=rng.randint(1, 9))) for _ in range(2)), counts)
    return Model(counts)


def split(text, model):
    spans = sentences(text, model)
    assert all(a < b and text[a:b] == text[a:b].strip() for a, b in spans)
    assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))
    covered = "".join(text[a:b] for a, b in spans)
    assert "".join(covered.split()) == "".join(text.split())
    return [text[a:b] for a, b in spans]


@pytest.mark.parametrize("text", [
    "The plant stood still.| No change was seen.", "Dr. Weber approved rows 3 to 9.| Nobody objected.", "Rows 0.5 and 9.17 were kept, e.g. the older ones.",
    "The desk closed the ticket at 5 p.m.| The feed was late.", "Is it real?!| Yes.| The desk closed.", "Notes\n\n|The plant\nstood still.| No change.",
    "A list:\n|- one. two\n|- three\n|* four", "1. Scope\n\n|The plant stood still.", "Closed on Apr.\n10.| The desk closed.", "1) one\n|2) two\n|3) three", "Open points\n|1. one\n|2. two", "See row\n1.| The desk closed.", "Points:\n|1. one", "0" * 5000 + ". one\n" + "9" * 5000 + ". two",
    "No change; it is real: yes - or not, so what.", 'The note asked: "Did he check? I doubt it."| The desk closed.', '"The feed was late. We loaded it twice," Ebert said.',
    "(Two rows share one. The later counts.)| No change was seen.", "The memo (it was short. It was wrong.) has gone.| No change.", "Row 9 reads \"n.a.\" instead.| The desk closed.",
    "「单位对吗？我看不对。」陈问道。|没有变化。|这不可能！", "原因不清楚.|数据组确认了．|没有变化", "数据组等了很久……最后才收到。", "データが遅れました。|変更なし。", "「遅れた。二回読んだ。」と彼は述べた。|変更なし。",
    "यह संभव नहीं!| कोई बदलाव नहीं।| मान क्यों नहीं है?", "कोई बदलाव नहीं|| यह संभव नहीं", "”ڈیٹا آیا۔ ہم نے لوڈ کیا۔“ علی نے کہا۔| کوئی تبدیلی نہیں۔", "መረጃው ትክክል አይደለም።| ለምን ጠፋ?| ገቢው ጨመረ።",
    "Γιατί λείπει η τιμή;| Δεν είναι σωστό!", "Տվյալները ճիշտ չեն։| Ինչո՞ւ է։", "ទិន្នន័យ។| គម្លាត។", "အချက်အလက် မမှန်ပါ။| ဘာကြောင့်။", "لماذا القيمة مفقودة؟| هذا غير ممكن!",
    "ระบบโหลดข้อมูลแล้ว| ค่าใหม่สูงขึ้น| ระบบโหลดข้อมูลแล้ว", "อื่น ๆ อีก 5 แถว",
])
def test_boundaries(model, text):
    # Marked by | ; a doubled one stands for the sign itself.
    plain = text.replace("||", "\0").replace("|", "").replace("\0", "|")
    expected = [p.replace("\0", "|").strip() for p in text.replace("||", "\0|").split("|")]
    assert split(plain, model) == expected


@pytest.mark.parametrize("text", ["", " ", "\n\n", "\xa0 "])
def test_blank(model, text):
    assert sentences(text, model) == []


@pytest.mark.parametrize("text", ['{"a": "Is it? Yes. No.", "b": 1}', "____________", "2015Q2=5.5 ; 2016Q1=10.6 ; 2016Q2=8.1", "a3f9" * 16, "Yes"])
def test_no_prose_is_one_sentence(model, text):
    assert split(text, model) == [text]


def test_line_ends_and_blank_lines():
    cut = lambda t: [t[a:b].strip() for a, b in blocks(t)]
    assert cut("a\r\nb\r\n\r\nc\n \t\nd\n\n\n\ne\rf\r\rg") == ["a\r\nb", "c", "d", "e\rf", "g"]


def test_pairs_and_classes():
    assert pairs("a (b [c] d) e) „f“ «g» \"h\" (i") == [(2, 10), (15, 17), (19, 21), (23, 25)]
    assert is_folded("alles klein geschrieben") and is_folded("ALL IN CAPITALS") and not is_folded("As usual") and not is_folded("日本語")
    assert is_prose("Some words.") and not is_prose("== 1 == 2 == 3 ==")


def test_long_text_is_whole(model):
    text = "The plant stood still. " * 20_000
    assert len(sentences(text, model)) == 20_000


@pytest.mark.parametrize("transition", [(0.0, 0.0, 0.0), (0.4, -0.7, 0.9)])
def test_best_path_agrees_with_all_paths(model, transition):
    import itertools

    block = "1. A. (No change. Yes.) The desk closed. 5. Is it? No. \"It is. Yes.\" The plant"
    found = boundaries.candidates(block)
    gains = [None if c.pair else boundaries._hard(block, c) if c.kind == "hard" else model.score(block, c, False) for c in found]

    def value(tags):
        begin, total, before = 0, 0.0, boundaries.START
        for c, g, tag in zip(found, gains, tags, strict=True):
            gain = boundaries._pair_score(block, c, begin, False) if g is None else g + transition[before]
            before = boundaries.END if tag else boundaries.GOES_ON
            if tag:
                letter = any(x.isalpha() for x in block[begin : c.end])
                total += gain / 2 + (0 if letter or c.end - begin >= boundaries._LONG_ENOUGH else boundaries._NO_LETTER)
                begin = c.after
            else:
                total -= gain / 2
        return total

    best = max(itertools.product([0, 1], repeat=len(found)), key=value)
    ours = set(boundaries._best_path(block, found, gains, False, 0, transition))
    assert value(best) == pytest.approx(value([k in ours for k in range(len(found))]))


def test_documents(spark, model):
    texts = [(1, "The plant stood still. No change was seen."), (2, None), (3, ""), (4, " "), (5, "Yes"), (5, "Yes")]
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in texts], "doc_id long, text string, start_char string, n_chars int")
    found = sorted(tuple(r) for r in sentence_spans(df, model).collect())
    assert found == [(1, 0, 22), (1, 23, 42), (5, 0, 3), (5, 0, 3)]
    assert sentence_spans(df.limit(0)).count() == 0
    assert train(df.limit(0)).next == {}


AT = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(AT), reason="no tables here")
def test_paragraph_ends_are_predicted_without_their_breaks(spark):
    """Held-out: paragraph breaks of documents the tagger wasn't trained on are replaced by spaces and must be found."""
    documents = spark.read.parquet(f"{AT}/documents.parquet").where("text IS NOT NULL")
    tagger = train(documents.where("doc_id % 2 = 0"))
    held = [r["text"] for r in documents.where("doc_id % 2 = 1").select("text").collect()]
    hit = total = 0
    ends_marks = boundaries.SOFT + boundaries.HARD
    for text in held:
        if not is_prose(text) or "\n\n" not in text.strip():
            continue
        parts = [p.strip() for p in text.split("\n\n") if p.strip()]
        if any(p[0] in "-•*" or p[0].isdigit() or "\n" in p or p[-1] not in ends_marks and not "ก" <= p[-1] <= "๛" for p in parts):
            continue
        joined, at, breaks = " ".join(parts), 0, []
        for p in parts[:-1]:
            at += len(p) + 1
            breaks.append(at - 1)
        ends = {b for _, b in sentences(joined, tagger)}
        hit += sum(b in ends for b in breaks)
        total += len(breaks)
    assert total > 1000 and hit / total > 0.99


def test_training_counts_every_document(spark):
    texts = [f"The value rose by {k} % in w{k}. Then it fell.\n\nNothing else." for k in range(6_000)]
    counts = Counter()
    for text in texts:
        count_text(text, counts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert train(df).next == Model(counts).next


STRIPPED = {
    "zh": (["数据组确认了报告", "收入比上一季度高", "没有任何变化", "审计员拒绝了新值", "单位从千改成了百万", "工厂关闭了两周"], "。", ""),
    "ja": (["データが遅れました", "売上は増えています", "変更はありません", "監査人が確認しました", "単位が変わりました"], "。", ""),
    "my": (["အချက်အလက် မမှန်ပါ", "ဝင်ငွေ တိုးလာသည်", "ပြောင်းလဲမှု မရှိပါ", "စာရင်းစစ် အတည်ပြုသည်"], "။", " "),
    "km": (["ទិន្នន័យមិនត្រឹមត្រូវ", "ចំណូលកើនឡើង", "គ្មានការផ្លាស់ប្តូរ", "សវនករបានបញ្ជាក់"], "។", " "),
}


@pytest.fixture(scope="module")
def stripped_model():
    rng, counts = random.Random(9), Counter()
    for _ in range(400):
        pool, mark, gap = rng.choice(list(STRIPPED.values()))
        count_text("\n\n".join("".join(x + mark + gap for x in rng.choices(pool, k=rng.randint(2, 7))).strip() for _ in range(2)), counts)
    return Model(counts)


@pytest.mark.parametrize("script", STRIPPED)
@pytest.mark.parametrize("between", ["", " "])
def test_texts_without_any_mark_in_scripts_without_spaces(stripped_model, script, between):
    rng, (pool, mark, _) = random.Random(4), STRIPPED[script]
    found = right = true = 0
    for _ in range(60):
        parts = rng.choices(pool, k=rng.randint(2, 6))
        text, ends, at = between.join(parts), set(), 0
        for p in parts:
            at += len(p)
            ends.add(at)
            at += len(between)
        mine = {b for _, b in sentences(text, stripped_model)}
        found, right, true = found + len(mine), right + len(mine & ends), true + len(ends)
    assert right / true > 0.95 and right / found > 0.95


def test_chain_is_the_best_of_all_paths():
    from itertools import product

    rng = random.Random(3)
    for _ in range(300):
        gains, t = [rng.uniform(-2, 2) for _ in range(rng.randint(1, 7))], [rng.uniform(-1.5, 1.5) for _ in range(3)]

        def worth(tags, gains=gains, t=t):
            before, total = boundaries.START, 0.0
            for tag, g in zip(tags, gains, strict=True):
                total += (1 if tag else -1) * (g + t[before]) / 2
                before = boundaries.END if tag else boundaries.GOES_ON
            return total

        best = max(product([False, True], repeat=len(gains)), key=worth)
        assert boundaries._chain(gains, tuple(t)) == [k for k, tag in enumerate(best) if tag]


def test_quick_candidates_are_those_of_the_full_search():
    rng, signs = random.Random(8), ["a", "B", "é", "1", " ", "  ", "\n", ".", ".", "!", "?", "…", ",", "(", ")", '"', "“", "”", "»", "-", "x."]
    for _ in range(4000):
        block = "".join(rng.choices(signs, k=rng.randint(1, 25))).strip()
        if block and not boundaries.is_manifold(block):
            assert [c[:5] for c in boundaries.quick_candidates(block)[0]] == [c[:5] for c in boundaries.candidates(block)], block


def test_a_saved_model_gives_the_same_sentences(spark, tmp_path):
    from quarterline.llm import sentences as module

    rng = random.Random(6)
    texts = ["\n\n".join(" ".join(rng.choices(POOLS[k % 3], k=6)) for _ in range(3)) for k in range(60)]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    trained = train(documents)
    module.save(trained, spark, f"{tmp_path}/model.json")
    with pytest.raises(FileExistsError):
        module.save(trained, spark, f"{tmp_path}/model.json")
    again = module.load(spark, f"{tmp_path}/model.json")
    assert again.counts == trained.counts
    spans = lambda df, model: sorted(map(tuple, sentence_spans(df, model).collect()))
    assert spans(documents, again) == spans(documents, None)
    few = documents.where("doc_id < 3")
    assert spans(few, again) == [x for x in spans(documents, again) if x[0] < 3]
