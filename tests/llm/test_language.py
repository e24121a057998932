import pytest

from sensorloom.llm import language
from sensorloom.llm.common import table
from tests.llm.samples import frame, odd_rows, rows_of

DIR = "/root/testdata/sf0.01"
EVIDENCE = "id bigint, text string, declared string, suffix string, domain string, host string"


@pytest.fixture(scope="module")
def model(spark):
    return language.train(table(spark, DIR, "documents").where("doc_id % 2 = 0"))


def test_held_out_documents_by_text_alone(spark, model):
    rows = table(spark, DIR, "documents").where("doc_id % 2 = 1").selectExpr(
        "doc_id AS id", "text", "null AS declared", "null AS suffix", "null AS domain", "null AS host", "lang")
    found = language.identify(rows, model).join(rows.select("id", F_lang(rows)), "id").collect()
    assert sum(r.lang == r.true for r in found) >= 0.97 * len(found)
    assert all(r.keep for r in found)


def F_lang(rows):
    return rows["lang"].alias("true")


def test_pages_agree_with_their_markup(spark, model):
    evidence = language.page_evidence(table(spark, DIR, "pages"))
    blind = evidence.selectExpr("id", "text", "null AS declared", "suffix", "domain", "host")
    found = language.identify(blind, model).join(evidence.select("id", "declared"), "id").collect()
    assert sum(r.lang == r.declared for r in found) >= 0.97 * len(found)


def test_weak_texts_follow_the_other_evidence(spark, model):
    french = table(spark, DIR, "documents").where("lang = 'fr' AND doc_id % 2 = 1").selectExpr(
        "doc_id AS id", "text", "'fr' AS declared", "'fr' AS suffix", "'site.fr' AS domain", "'www.site.fr' AS host")
    weak = spark.createDataFrame(
        [(-1, "on", None, None, None, "www.site.fr"), (-2, "on", None, None, "site.fr", "new.site.fr"), (-3, "on", "fr", None, None, None),
         (-4, "on", None, "fr", None, None)], EVIDENCE)
    found = {r.id: r for r in language.identify(french.union(weak), model).collect()}
    assert {found[i].lang for i in (-1, -2, -3, -4)} == {"fr"}


def test_odd_rows_and_empty_tables(spark, model):
    rows = frame(spark, odd_rows()).selectExpr(
        "doc_id AS id", "text", "lang AS declared", "null AS suffix", "null AS domain", "source AS host", "secrets AS score")
    found = language.identify(rows, model).collect()
    assert len(found) == len(odd_rows())
    assert all((r.lang is None) == (r.n_grams == 0) and (r.n_grams > 0 or not r.keep) for r in found)
    assert language.identify(rows.where("false"), model).count() == 0
    empty = language.train(frame(spark, []))
    assert empty.languages == []
    assert not any(r.keep for r in language.identify(rows, empty).collect())


def test_keep_identified(spark):
    documents = frame(spark, odd_rows())
    kept = language.keep_identified(documents)
    assert kept.columns == documents.columns
    gone = [r for r in rows_of(documents) if r[1] is None or not any(c.isalpha() for c in r[1])]
    assert len(gone) == 4
    assert rows_of(kept) == sorted((r for r in rows_of(documents) if r not in gone), key=repr)
    assert language.keep_identified(frame(spark, [])).count() == 0


def test_page_evidence(spark):
    pages = spark.createDataFrame([
        (1, "https://user@www.Shop.example.de:80/x?y", '<html class="a" lang="DE-at"><script>var x="</p>";</script><p>Gut&amp;<b>en</b> <!-- no --> Tag'),
        (2, None, None), (3, "no address", "plain")], "page_id bigint, url string, html string")
    found = {r.id: r for r in language.page_evidence(pages).collect()}
    assert found[1].text.split() == ["Gut", "en", "Tag"]
    assert (found[1].declared, found[1].suffix, found[1].domain, found[1].host) == ("de", "de", "example.de", "www.shop.example.de")
    assert (found[2].text, found[2].declared, found[2].host) == (None, None, None)
    assert (found[3].text, found[3].declared, found[3].host) == ("plain", None, None)


# Article 1 of the Universal Declaration of Human Rights, in languages of which the tables hold nothing.
UNTRAINED = {
    "el": "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "hu": "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván.",
    "ja": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem.",
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
}


def test_other_languages_are_none_of_the_known(spark, model):
    rows = [(i, text, None, None, None, None) for i, text in enumerate(UNTRAINED.values())]
    rows += [(100 + i, text, "en", "com", "site.com", "www.site.com") for i, text in enumerate(UNTRAINED.values())]
    rows.append((200, "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822cd15d6c15b0f00a08e3b0c44298fc1c149afbf4c8996fb92427ae41e4", *[None] * 4))
    known = table(spark, DIR, "documents").where("doc_id % 2 = 1").selectExpr(
        "-doc_id AS id", "text", "null AS declared", "null AS suffix", "null AS domain", "null AS host")
    found = language.identify(known.union(spark.createDataFrame(rows, EVIDENCE)), model).where("id >= 0").collect()
    assert len(found) == len(rows)
    assert all(r.text_lang is None and not r.keep and r.posterior < 0.5 for r in found)


def test_more_languages_than_the_model_holds(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 3)
    letters = {"aa": "abcde", "bb": "fghij", "cc": "klmno", "dd": "pqrst", "ee": "uvwxy"}
    rows = []
    for weight, (lang, own) in enumerate(reversed(letters.items())):
        words = [x + y + z for x in own for y in own for z in own]
        rows += [(1000 * weight + i, " ".join(words[i % 25::2]), lang) for i in range(10 + 10 * weight)]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.train(labelled)
    assert model.languages == ["aa", "bb", "cc"] and len(model.table) == 4
    found = language.identify(labelled.selectExpr(
        "struct(doc_id, lang) AS id", "text", "null AS declared", "null AS suffix", "null AS domain", "null AS host"), model)
    for r in found.collect():
        known = r.id.lang in model.languages
        assert r.keep == known and r.text_lang == (r.id.lang if known else None) and (r.lang == r.id.lang or not known)
