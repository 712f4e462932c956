import random
import re

import cases

from peakloom.llm import licences


def test_automaton_and_its_pattern_agree():
    draw = random.Random(6)
    templates = [*licences.TEMPLATES.values(), "a <<optional>>b <<any:2>> c<</optional>> d", "<<optional>>x<</optional>> a <<any:1>> b"]
    for template in templates:
        automaton = licences.Automaton(template)
        pattern = re.compile(automaton.pattern())
        pool = [w for w in re.sub(r"<<[^>]*>>", " ", template).split()] + ["other"]
        plain = re.sub(r"<<[^>]*>>", " ", template).split()
        for _ in range(300):
            words = [w for w in plain if draw.random() > 0.08]
            for _ in range(draw.randint(0, 3)):
                words.insert(draw.randint(0, len(words)), draw.choice(pool))
            assert automaton.accepts(w.encode() for w in words) == bool(pattern.match("".join(f"{w} " for w in words))), words


def test_scan(spark):
    texts = [
        "Released under the MIT License.",
        "released under the terms of the mit license and more",
        "released under terms of the MIT license",
        "Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0",
        "This fine work is licensed under the GNU General Public License, version 3. Apache License",
        "This one two three four is licensed under the GNU General Public License, version 2.",
        "mit " * 30_000 + "license",
        "MIT, License; mit license cc by cc by",
        "submit license",
        None,
        "",
        "Released under the MIT License.",
    ]
    docs = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "doc_id bigint, text string, score string")
    rows = {r.doc_id: r for r in licences.scan(docs).collect()}
    assert len(rows) == len(texts) and all(r.score == "own" for r in rows.values())
    labels = {i: ",".join(r.license["all"]) for i, r in rows.items()}
    assert labels == {
        0: "mit", 1: "mit", 2: "mit", 3: "cc-by,cc-by-4.0,cc-by-nc-4.0", 4: "apache,gpl,gpl-3.0", 5: "gpl,gpl-2.0",
        6: "mit", 7: "cc-by,mit", 8: "", 9: "", 10: "", 11: "mit",
    }
    for i, text in enumerate(texts):
        w = cases.words(text)
        places = [
            (at, label)
            for phrase, label in licences.PHRASES.items()
            for at in range(len(w))
            if w[at : at + len(phrase.split())] == phrase.split()
        ]
        got = rows[i].license
        assert (got.n_words, got.n_base) == (len(w), len(places))
        assert got.first_word == min((p for p, _ in places), default=None)
        assert got.last_word == max((p for p, _ in places), default=None)
        assert got.base == sorted({label for _, label in places})
    assert [rows[i].license.score for i in (0, 2, 8)] == [1.0, 0.5, 0.0]
    assert licences.scan(docs.where("false")).count() == 0
