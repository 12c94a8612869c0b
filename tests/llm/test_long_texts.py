"""The verdict on clean prose does not change with its length."""

from collections import Counter

import numpy as np
import pandas as pd
import pytest

from tideline.llm import queries, rules


@pytest.fixture(scope="module")
def tools():
    return rules.Tokenisers(open(queries.PIECE_BPE, "rb").read(), open(queries.BYTE_BPE, "rb").read())


@pytest.mark.parametrize("lang", ["en", "de", "fr"])
def test_clean_text_is_kept_at_any_length(tools, lang):
    sf = "/root/testdata/sf0.1"
    docs = pd.read_parquet(f"{sf}/documents.parquet").merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    words = " ".join(docs[(docs["quality"] == 1) & (docs["lang"] == lang)].drop_duplicates("text")["text"]).split()
    names = [n for n, _, _ in rules.RESULT]
    low = []
    for n in (1_000, 100_000, 1_000_000):
        # beyond the given text its words come again in sentences of another order, so that no window repeats
        rng, more = np.random.default_rng(n), list(words[:n])
        while len(more) < n:
            more += [words[(k + j) % len(words)] for k in rng.integers(0, len(words), 5_000) for j in range(5)]
        got = dict(zip(names, rules.judge_all([" ".join(more[:n])], [lang], tools, rules.BANDS)[0]))
        assert got["n_words"] == n and got["kept"], got
        low.append(got["window_entropy"])
    assert max(low) - min(low) < 0.1


def test_windows_cover_the_whole_text(tools):
    words = [f"w{k % (3 + k // 900)}".encode() for k in range(5_000)]
    ids = [i for w in words for i in tools.pieces.encode(w.decode())]
    size = rules.ENTROPY_WINDOW
    edges = [*range(0, (len(ids) // size) * size, size), len(ids)]
    want = 0.0
    for a, b in zip(edges, edges[1:]):
        p = np.array(list(Counter(ids[a:b]).values())) / (b - a)
        want += (b - a) * -(p * np.log2(p)).sum() / np.log2(b - a)
    others = [words[:7], [], [b"one"], words]
    assert [m[3] for m in tools.measure_all(others, [1] * 4)][1:] == [0.0, pytest.approx(1.0), pytest.approx(want / len(ids))]


def test_repetitive_text_is_rejected_at_any_length(tools):
    rng = np.random.default_rng(1)
    for n in (1_000, 100_000):
        text = " ".join(rng.choice(["house", "tree"], n, p=[0.9, 0.1]))
        assert tools.measure_all([text.encode().split()], [len(text) - n + 1])[0][3] < rules.BANDS.by_lang["en"].window_entropy


def test_very_long_words(tools):
    """One word of more tokens than a marker holds."""
    word = "ab1" * 20_000
    ids, tokens = tools.pieces.encode(word), len(tools.bytes.encode_ordinary(" " + word))
    (per_piece, per_token, _, _), = tools.measure_all([[word.encode()]], [len(word)])
    assert (per_piece, per_token) == (pytest.approx(len(word) / len(ids)), pytest.approx(len(word) / tokens))


PROSE = {
    "Cyrl": "Вчера вечером мы долго гуляли по старому городу и смотрели, как над рекой медленно садится солнце. На площади играли музыканты, дети бегали вокруг фонтана, а взрослые сидели на скамейках и говорили о работе и погоде.",
    "Arab": "في مساء أمس مشينا طويلا في المدينة القديمة ونظرنا إلى الشمس وهي تغرب ببطء فوق النهر. كان الموسيقيون يعزفون في الساحة والأطفال يركضون حول النافورة والكبار يجلسون على المقاعد ويتحدثون عن العمل والطقس.",
    "Deva": "कल शाम हम पुराने शहर में बहुत देर तक घूमते रहे और देखते रहे कि नदी के ऊपर सूरज धीरे धीरे कैसे डूबता है। चौक में संगीतकार बजा रहे थे, बच्चे फव्वारे के चारों ओर दौड़ रहे थे।",
    "Thai": "เมื่อวาน ตอนเย็น เรา เดินเล่น ใน เมืองเก่า เป็นเวลานาน และ มองดู พระอาทิตย์ ค่อยๆ ตก เหนือ แม่น้ำ ที่ จัตุรัส มี นักดนตรี กำลัง เล่นเพลง เด็กๆ วิ่งเล่น รอบ น้ำพุ",
    "Hang": "어제 저녁 우리는 오래된 도시를 오랫동안 걸으며 강 위로 해가 천천히 지는 것을 바라보았다. 광장에서는 음악가들이 연주하고 아이들은 분수 주위를 뛰어다녔으며 어른들은 벤치에 앉아 일과 날씨에 대해 이야기했다.",
    "Hani": "昨天 晚上 我们 在 老城 里 走 了 很 久 ， 看 太阳 慢慢 落 到 河 的 那 边 。 广场 上 有 音乐家 在 演奏 ， 孩子们 围着 喷泉 跑 ， 大人 坐 在 长椅 上 谈 工作 和 天气 。",
    "Latn": "Gisteren avond liepen we lang door de oude stad en keken hoe de zon langzaam boven de rivier onderging. Op het plein speelden muzikanten, kinderen renden rond de fontein en de volwassenen zaten op banken.",
}
LETTERS = {"Cyrl": (0x430, 0x450), "Arab": (0x627, 0x64B), "Deva": (0x905, 0x93A), "Thai": (0xE01, 0xE2F), "Hang": (0xAC00, 0xD7A4), "Hani": (0x4E00, 0x9FA6), "Latn": (97, 123)}


@pytest.mark.parametrize("script", PROSE)
def test_prose_is_kept_and_random_letters_go(tools, script):
    rng = np.random.default_rng(3)
    words = PROSE[script].split()
    random = [" ".join("".join(map(chr, rng.integers(*LETTERS[script], len(w)))) for w in words * k) for k in (1, 8)]
    verdicts = [r[6] for r in rules.judge_all([PROSE[script], *random], [None] * 3, tools, rules.BANDS)]
    assert rules.script(PROSE[script]) == script and verdicts == [True, False, False]
