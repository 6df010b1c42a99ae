"""Labels that disagree must not turn away documents in a learned language."""

import random

from corpusloom.llm import language

WORDS = {
    "de": "der die das und nicht mit auf ein eine ist sind von für werden auch als nach über durch wir haben wenn noch".split(),
    "en": "the and of that with for this from have not are was which they their would there been more when who will".split(),
    "fr": "le la les des et que dans une pour qui sur pas plus avec sont est cette mais comme nous vous leur aux été".split(),
    "es": "el los las del que por con una para como más pero sus este entre cuando muy sin sobre también hasta donde".split(),
}


def text(rng, lang, n=60):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def test_texts_under_several_languages_keeps_clean_documents():
    rng = random.Random(3)
    same = [text(rng, "en") for _ in range(100)]
    rows = [(text(rng, k), k) for _ in range(200) for k in WORDS] + [(t, k) for t in same for k in WORDS]
    rng.shuffle(rows)
    model = language.train([t for t, _ in rows], [k for _, k in rows])
    clean = [(text(rng, k, n), k) for n in (8, 60, 400) for k in WORDS for _ in range(25)]
    names, _, out = model.predict([t for t, _ in clean] + same)
    assert sum(out) <= 0.01 * len(out) and not out[len(clean) :].any()
    assert sum(a == b for a, (_, b) in zip(names, clean)) >= 0.97 * len(clean)
    assert model.predict(["Съешь же ещё этих мягких французских булок да выпей чаю"])[2].all()
