import os
import random

import pytest
from pyspark.sql import functions as F

from hustings.llm.spam import Vocabulary, learned_words, measured, spam_pages, spam_share, spam_steps

PROSE = [
    "The clerk said that the list will be posted at the town hall before the end of the week.",
    "A resident asked why the ferry dock has not been repaired, and the mayor promised an answer in May.",
    "Nobody from the planning office was at the meeting, so the vote on parking was moved to the autumn.",
    "It is not yet known whether the new polling place in the library will be open by then.",
    "Two of the candidates have withdrawn, which means that the third one is elected without a vote.",
    "We checked the names by hand and found that one of them had been spelled in two ways.",
    "If the road is closed on that day, the buses will stop in front of the school instead.",
    "She has lived in the ward for twenty years and wants to speak about housing and the budget.",
]
FRENCH = [
    "Le conseil a renvoyé le dossier sur le logement au comité par neuf voix contre deux.",
    "La directrice du scrutin n'a pas répondu aux questions de la salle sur les bureaux de vote.",
    "Les électeurs de la ville peuvent choisir jusqu'à trois personnes sur la liste, selon l'avis.",
]
TOWNS = ["Elmside", "Oakton", "Ashford", "Larkwell", "Foxmere", "Deepdale", "Kingsham", "Yewgate"]


def prose(rng, n, kind=PROSE):
    return " ".join(rng.choice(kind) for _ in range(n))


def spam(rng, kind):
    keys = ["cheap yard signs", "custom banners", "promo pens"]
    if kind == 0:
        return " ".join(rng.choice([str.upper, str.title, str])(rng.choice(keys)) for _ in range(40))
    if kind == 1:
        return "\n".join(f"https://shop{rng.randint(1, 9)}.example/{rng.choice(keys).replace(' ', '-')}?ref={rng.randint(1, 999)}" for _ in range(12))
    if kind == 2:
        return "\n".join(f'<a href="https://shop7.example/{rng.randint(1, 99)}">{rng.choice(keys)}</a>' for _ in range(9))
    if kind == 3:
        return " ".join("#" + rng.choice(["felt", "teal", "banner", "promo_pens", "cord"]) for _ in range(30))
    if kind == 4:
        return "\n".join(f"SKU-{rng.randint(1000, 9999)} / {rng.choice(['teal', 'navy'])} / felt / ${rng.randint(1, 99)}.99" for _ in range(9))
    if kind == 5:
        return ", ".join(rng.sample(["ivory", "sleeve", "easel", "label", "button", "ticket", "roll", "cord", "teal", "amber", "sash", "stake", "magnet", "flag", "wrap"], 15))
    return " ".join(f"Our {a} {b} and {a} with {b} {rng.choice(TOWNS)}. Why {a}? Because {a} {b} {a}." for a, b in (rng.sample(keys, 2) for _ in range(6)))


def lists(rng, kind):
    name = lambda: rng.choice(["Ba", "Ko", "Li", "Mu", "Ta"]) + "".join(rng.choice(["ra", "ndo", "mel", "quist", "vane", "shi"]) for _ in range(3))
    if kind == 0:
        return "\n".join(f"Councillor, Ward {rng.randint(1, 20)}: {name().upper()}, {name()}; {name().upper()}, {name()}" for _ in range(15))
    if kind == 1:
        return "candidate\tvotes\tshare\n" + "\n".join(f"{name()} {name()}\t{rng.randint(1, 9999)}\t{rng.randint(1, 99)}.5%" for _ in range(15))
    if kind == 2:
        return "\n".join(f"Poll {rng.randint(1, 400)}: town hall, {rng.randint(1, 900)} {name()} Lane, 10 a.m. to 8 p.m." for _ in range(15))
    if kind == 3:
        return "\n".join(f"{i}.1 Moved by {name()} {name()}, seconded by {name()} {name()}, that the report on {name()} be received. Carried." for i in range(12))
    return "\n".join(f"- {rng.choice(PROSE)} See https://vote.example/{name()}/{rng.randint(1, 99)} as of May 4." for _ in range(8))


def test_found_of_a_made_corpus(spark):
    rng = random.Random(11)
    rows, want = [], set()
    for i in range(600):
        roll = rng.random()
        if roll < 0.12:
            bad = spam(rng, i % 7)
            rows.append((i, bad if roll < 0.06 else prose(rng, 1) + "\n" + bad, rng.choice(["en", "fr", None, "EN-ca"])))
            want.add(i)
        elif roll < 0.3:
            rows.append((i, lists(rng, i % 5), "en"))
        elif roll < 0.4:
            rows.append((i, prose(rng, 6) + "\n#felt #teal #cord", "en"))
        else:
            rows.append((i, prose(rng, rng.randint(1, 30), FRENCH if roll > 0.9 else PROSE), "en"))
    rows += [(1000, None, "en"), (1001, "", "en"), (1002, " \n\t", None), (None, spam(rng, 0), "en"), (1003, "ok", None), rows[0], *[(1004, spam(rng, 1) * 200, "en")] * 2, (1005, prose(rng, 3_000), "en")]
    want.add(1004)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("share", F.lit(1)).withColumn("distance", F.lit(1))
    got = [r["doc_id"] for r in spam_pages(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert spam_pages(df.limit(0)).collect() == []
    steps = {r["step"]: r["n"] for r in spam_steps(df).collect()}
    # A tenth of this corpus is prose with a few tags and a fifth lists, so the distance has much to flag.
    assert 0.3 * steps["judged"] > steps["flagged"] >= steps["cases"] == len(want) + 1 and steps["outlying"] >= steps["flagged"]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_the_distance_decides(spark):
    """On whole documents the reading drops fewer than half of what the distance and its direction flag."""
    steps = {r["step"]: r["n"] for r in spam_steps(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    assert steps["judged"] > steps["outlying"] >= steps["flagged"] >= steps["cases"] > steps["flagged"] / 2


def test_no_text_is_joined_or_shuffled(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, spam(rng, i % 7) if i % 9 == 0 else prose(rng, 8), "en") for i in range(400)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(8).write.parquet(str(tmp_path / "d"))
    plan = spam_pages(spark.read.parquet(str(tmp_path / "d")))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and not [line for line in plan.splitlines() if "Exchange" in line and "text" in line]


UNLISTED = {
    "de": "Die Stadt hat am Montag mitgeteilt, dass die Liste der Bewerber im Rathaus ausgehängt wird. Wer sich nicht eintragen lässt, kann im Herbst nicht wählen. Der Bürgermeister sprach lange über den Haushalt und die Schulen. Am Ende des Abends blieben viele Fragen offen.",
    "tr": "Belediye başkanı dün akşam halka seslendi ve yeni köprünün ne zaman biteceğini anlattı. Seçim listesi hafta sonuna kadar belediye binasında asılı kalacak. Birçok kişi toplantıya geç geldi çünkü yollar karla kaplıydı.",
    "ko": "시장은 어제 저녁 주민들에게 새 다리가 언제 완공되는지 설명했다. 선거 명부는 주말까지 시청에 게시될 것이다. 많은 사람들이 눈 때문에 회의에 늦게 도착했다. 이웃은 왜 학교가 문을 닫았는지 물었지만 아무도 대답하지 않았다.",
    "pl": "Burmistrz powiedział wczoraj, że lista kandydatów zostanie wywieszona w ratuszu przed końcem tygodnia. Wielu mieszkańców przyszło na spotkanie mimo śniegu. Nikt nie wiedział, dlaczego most nadal jest zamknięty.",
    "fi": "Kaupunginjohtaja kertoi eilen, että ehdokasluettelo pannaan esille kaupungintalolle ennen viikon loppua. Moni asukas saapui kokoukseen lumesta huolimatta. Kukaan ei tiennyt, miksi silta on yhä suljettu.",
    "ja": "市長は昨日、候補者の名簿が週末までに市役所に掲示されると述べた。雪にもかかわらず多くの住民が会合に来た。橋がまだ閉鎖されている理由は誰も知らなかった。",
}


@pytest.mark.parametrize("lang", UNLISTED)
def test_prose_of_unlisted_languages(lang):
    text = UNLISTED[lang]
    ends = "。" if lang == "ja" else "."
    sentences = [s.strip() + ends for s in text.split(ends) if s.strip()]
    rng = random.Random(1)
    assert spam_share(text) < 0.1
    assert spam_share(" ".join(rng.choice(sentences) for _ in range(30))) < 0.1
    assert measured(text, "xx")[0] is None


def test_words_of_unlisted_languages_come_from_the_corpus(spark):
    rng = random.Random(8)
    sentences = UNLISTED["de"].split(". ")
    rows = [(i, ". ".join(rng.sample(sentences, 3)), rng.choice(["de", "DE-at"])) for i in range(60)] + [(100 + i, prose(rng, 4), rng.choice(["de", "en"])) for i in range(60)]
    words = learned_words(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert set(words) == {("latin", "de")} and {"die", "der", "im", "und"} <= words["latin", "de"] and "the" not in words["latin", "de"]
    assert measured(UNLISTED["de"], None, Vocabulary(words))[0] == "de"


def test_nothing_is_cut_by_length():
    anchor = "cheap yard signs and custom banners of the shop " * 4
    assert spam_share("\n".join(f"[{anchor}{i}](https://shop7.example/{i})" for i in range(6))) > 0.8
    assert spam_share("\n".join(f'<a href="https://shop7.example/{i}" title="{anchor}">{anchor}</a>' for i in range(6))) > 0.8
    for ch in "[<#\t\"":
        assert 0 <= spam_share(ch * 50_000) <= 1 and all(0 <= x <= 1 for x in measured(ch * 50_000)[1])


@pytest.mark.parametrize("kind", range(5))
def test_lists_are_no_spam(kind):
    assert spam_share(lists(random.Random(kind), kind)) < 0.45


@pytest.mark.parametrize("kind", range(7))
def test_spam_is(kind):
    assert spam_share(spam(random.Random(kind), kind)) > 0.8


def test_numbers_alone_dont_exempt_a_line():
    rng = random.Random(5)
    keys = ["ward map", "mayor debate", "voting hours"]
    stuffed = [f"best {rng.choice(keys)} {rng.choice(TOWNS)} 2026" for _ in range(40)]
    for text in (" ".join(stuffed), " | ".join(stuffed), ", ".join(["call 7 clerks", *stuffed]), "\t".join(stuffed), '"' + '" "'.join(stuffed) + '"'):
        assert spam_share(text) > 0.8
    assert spam_share(", ".join(rng.choice(["vote 2026", "ward councillor", "candidate list"]) for _ in range(40))) > 0.8
    # Tables and counts on one line or with words that recur from row to row stay data.
    for text in (
        "; ".join(f"Ward {i}: {137 * i} votes cast" for i in range(1, 30)),
        "; ".join(f"{t} Kova 0 for, 5 against" for t in TOWNS * 3),
        "\n".join(f"{t}\tward\tacclaimed\tnot yet sworn" for t in TOWNS * 3),
        "\n".join(f'"{t}","ward clerk","town hall"' for t in TOWNS * 3),
        "[" + ", ".join(f'{{"ward": "2026", "office": "{t}"}}' for t in TOWNS * 3) + "]",
    ):
        assert spam_share(text) < 0.45


CHINESE = ["选举办公室说，{}的名单将在本周末以前贴在{}。", "一位居民问，为什么{}还没有修好，{}答应五月回答。", "{}没有人出席会议，所以关于{}的表决推迟到秋天。", "现在还不知道{}里的新投票站到时候是否对{}开放。"]


def test_latin_keywords_behind_chinese_prose(spark):
    rng = random.Random(6)
    name = lambda: "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(rng.randint(2, 5)))
    chinese = lambda n: "".join(rng.choice(CHINESE).format(name(), name()) for _ in range(n))
    stuffed = lambda n: " ".join(f"best {rng.choice(['yard signs', 'custom banners', 'promo pens'])} {rng.choice(TOWNS)}" for _ in range(n))
    late = chinese(180) + "\n" + stuffed(1_500)
    assert measured(late, "zh")[0] != "zh" and measured(chinese(180), "zh")[0] == "zh"
    rows = [(i, prose(rng, rng.randint(2, 30)), "en") for i in range(200)] + [(200 + i, chinese(rng.randint(3, 60)), "zh") for i in range(60)]
    # The script of the second is Chinese by its letters over the whole text; more than half of its characters are keywords.
    rows += [(1000, late, "zh"), (1001, chinese(60) + "\n" + stuffed(100), "zh"), (1002, chinese(200) + "\nSee the list of Oakton and Ashford.", "zh")]
    assert measured(rows[-2][1], "zh")[0] == "zh" and spam_share(rows[-2][1]) > 0.5
    assert {r["doc_id"] for r in spam_pages(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()} == {1000, 1001}


def test_share_follows_the_mixture():
    rng = random.Random(4)
    text, bad = prose(rng, 8), spam(rng, 1)
    size = lambda t: len("".join(t.split()))
    assert abs(spam_share(text + "\n" + bad) - size(bad) / (size(text) + size(bad))) < 0.05


def test_languages_and_features():
    for text, declared, language in [("这是 一个 的 了 选举", None, "zh"), ("Це виборці округу та ради", "en", "uk"), (FRENCH[0], "en", "fr"), ("xyz", "fr-CA", "fr"), ("", None, None), (UNLISTED["de"], "de", None)]:
        assert measured(text, declared)[0] == language
    for text in ("", " ", "a", "https://a.example/b", "的" * 50, "#a #b", "\u0000"):
        assert all(0 <= x <= 1 for x in measured(text)[1]) and 0 <= spam_share(text) <= 1
