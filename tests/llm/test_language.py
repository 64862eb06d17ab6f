import random
import zlib

from wattframe.llm import language
from wattframe.llm.queries import language_model

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["schr", "ung", "eit", "ver"], "cc": ["при", "ход", "ать", "ов"]}


def text(lang, seed, count=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(count))


def rows(count=240):
    langs = list(SYLLABLES)
    return [(i, text(langs[i % 3], i, 5 + i % 80), langs[i % 3]) for i in range(count)]


def test_held_out_accuracy(docs):
    table = docs(rows())
    found = language.predict(table, language_model(table)).collect()
    truth = {i: lang for i, _, lang in rows()}
    held = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert held and sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_held_out_labels_do_not_matter(docs):
    table = docs(rows())
    changed = docs([(i, t, lang if zlib.crc32(str(i).encode()) % 4 != 2 else "aa") for i, t, lang in rows()])
    first = language.predict(table, language_model(table)).collect()
    assert sorted(first) == sorted(language.predict(table, language_model(changed)).collect())


def test_undetermined_and_rejected(docs):
    model = language_model(docs(rows()))
    odd = docs([(1, None), (2, ""), (3, "123 $$$ !!"), (4, text("aa", 1)), (None, text("bb", 2)), (5, "ξψω " * 160)])
    found = {r.doc_id: r for r in language.predict(odd, model).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3, 4, None)] == ["und", "und", "und", "aa", "bb"]
    assert found[5].rejected and found[5].lang_pred in SYLLABLES
    left = language.keep_determined(odd, model)
    assert left.columns == odd.columns
    assert {r.doc_id for r in left.collect()} == {4, None}


def test_long_text_and_nothing(docs, nothing, awkward):
    model = language_model(docs(rows()))
    assert language.predict(docs([(1, text("cc", 3, 40_000))]), model).first().lang_pred == "cc"
    assert language.predict(nothing, model).collect() == []
    empty = language_model(nothing)
    assert {r.lang_pred for r in language.predict(awkward, empty).collect()} == {"und"}
    assert language.predict(awkward, model).count() == 12
