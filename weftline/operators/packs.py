"""Pattern packs for the audits (C1, C2): which words of a locale mean which value of a dimension.

A pack is a table of patterns. Any pack can be audited; these two are the library's own. What can be told of any prose from
closed classes of words are its grammatical facets; who takes part is told by pronouns, number words and words for groups.
French has no patterns, as its texts are to be reported as unpatterned.
"""

from __future__ import annotations

from typing import NamedTuple

import regex


class Pattern(NamedTuple):
    """A text of the locale that has one of the words, as a word of its own in small letters, shows the value; with a regex
    only if that matches too. Keys say the same as a regex: two words with a space, which stand side by side, or a word with
    a point, which stands before a comma or full stop and a space."""

    dimension: str
    value: str
    locale: str
    id: str
    words: tuple[str, ...]
    regex: str | None = None
    keys: tuple[str, ...] = ()


def checked(patterns: list[Pattern]) -> list[Pattern]:
    """The patterns, if none could match every text, all are told apart, and words are words in small letters."""
    for p in patterns:
        if not p.words or not all(regex.fullmatch(r"[^\W\d_]+", w) and w == w.lower() for w in p.words):
            raise ValueError(f"empty or odd words in {p.locale} pattern {p.id}")
        if p.regex is not None and regex.search(p.regex, ""):
            raise ValueError(f"empty {p.locale} regex in {p.id}")
        if not (p.dimension and p.value and p.locale and p.id):
            raise ValueError("a pattern needs a dimension, a value, a locale and an id")
    if len({p.id for p in patterns}) != len(patterns):
        raise ValueError("two patterns share an id")
    return patterns


def pack(rows: dict[str, dict[str, dict[str, str]]]) -> list[Pattern]:
    """dimension -> value -> locale -> words."""
    return checked([Pattern(d, v, locale, f"{locale}-{d}-{v}", tuple(words.split())) for d, values in rows.items() for v, locales in values.items() for locale, words in locales.items()])


FACETS = pack({
    "article": {"definite": {"en": "the", "de": "der die das den dem des", "es": "el la los las"}, "indefinite": {"en": "a an", "de": "ein eine einen einem einer", "es": "un una unos unas"}},
    "connection": {"added": {"en": "and also", "de": "und auch", "es": "y e también"}, "chosen": {"en": "or either", "de": "oder entweder", "es": "o u"}, "opposed": {"en": "but yet although", "de": "aber sondern obwohl", "es": "pero sino aunque"}},
    "polarity": {"denied": {"en": "not no never none nor", "de": "nicht kein keine nie", "es": "no nunca nada ni"}, "affirmed": {"en": "yes indeed", "de": "ja doch", "es": "sí"}},
    "place": {"inside": {"en": "in into inside within", "de": "in im innerhalb", "es": "en dentro"}, "upon": {"en": "on upon onto", "de": "auf", "es": "sobre"}, "near": {"en": "at by near beside", "de": "bei neben an", "es": "junto cerca"}},
    "direction": {"towards": {"en": "to towards", "de": "zu zum zur nach", "es": "a al hacia"}, "from": {"en": "from off", "de": "von vom aus", "es": "desde"}},
    "relation": {"owned": {"en": "of", "de": "des", "es": "de del"}, "together": {"en": "with", "de": "mit", "es": "con"}, "without": {"en": "without", "de": "ohne", "es": "sin"}},
    "purpose": {"meant": {"en": "for", "de": "für um", "es": "para"}, "caused": {"en": "because since", "de": "weil wegen", "es": "por porque"}},
    "time": {"present": {"en": "is are am be", "de": "ist sind sein", "es": "es son está"}, "past": {"en": "was were been had", "de": "war waren hatte", "es": "era fue había"}, "future": {"en": "will shall", "de": "wird werden", "es": "será"}},
    "speaker": {"self": {"en": "i me my", "de": "ich mich mein", "es": "yo mi me"}, "addressed": {"en": "you your", "de": "du dich dein ihr", "es": "tú tu usted"}, "other": {"en": "he she it they", "de": "er sie es", "es": "él ella se"}},
    "pointing": {"close": {"en": "this these here", "de": "dies diese dieser hier", "es": "este esta esto aquí"}, "away": {"en": "that those there", "de": "jene jener dort da", "es": "ese esa aquel allí"}},
    "comparison": {"alike": {"en": "as like", "de": "wie als", "es": "como"}, "more": {"en": "more than", "de": "mehr", "es": "más"}, "less": {"en": "less fewer", "de": "weniger", "es": "menos"}},
    "clause": {"content": {"en": "that whether", "de": "dass daß ob", "es": "que si"}, "relative": {"en": "which who whose", "de": "welche welcher", "es": "cual quien cuyo"}},
})
SCALES = pack({"scale": {
    "individual": {"en": "i he she one alone each", "de": "ich er allein jeder", "es": "yo él ella solo cada"},
    "pair": {"en": "both two pair partner couple", "de": "beide beiden zwei paar partner", "es": "ambos dos pareja"},
    "small-group": {"en": "three four few several", "de": "drei vier wenige einige", "es": "tres cuatro pocos algunos"},
    "group": {"en": "we us they group", "de": "wir uns sie gruppe", "es": "nosotros ellos ellas grupo"},
    "team": {"en": "team side crew", "de": "mannschaft team", "es": "equipo bando"},
    "two-teams": {"en": "teams sides opponents", "de": "mannschaften gegner", "es": "equipos bandos rivales"},
    "crowd": {"en": "many crowd hundred", "de": "viele menge hundert", "es": "muchos multitud cien"},
    "everyone": {"en": "all everyone everybody", "de": "alle jedermann", "es": "todos todas"},
}})
_COUNTED = {"en": ("people players men participants", "two three four five six seven eight nine ten several"), "de": ("leute spieler personen teilnehmer", "zwei drei vier fünf sechs sieben acht neun zehn mehrere"), "es": ("personas jugadores participantes", "dos tres cuatro cinco seis siete ocho nueve diez varios")}
#: Numbers of those who take part: digits, or words, before a word for them.
NUMERIC = checked([Pattern("numeric", kind, locale, f"{locale}-numeric-{kind}", tuple(nouns.split()), rf"(?:^|[^\p{{L}}\p{{N}}]){number} +(?:{'|'.join(nouns.split())})(?:[^\p{{L}}]|$)") for locale, (nouns, words) in _COUNTED.items() for kind, number in (("digits", "[1-9][0-9]*"), ("words", f"(?:{'|'.join(words.split())})"))])

#: Function words of each locale, as they stand beside other words.
_BESIDE = {"en": "the and of to in that it for was on", "de": "der die und das ein von mit ist den zu", "es": "de la que el en los se por con una"}


def phrases(patterns: list[Pattern]) -> list[Pattern]:
    """Two more patterns for each: one of its words right before or after a function word, and one of its words before a
    comma or full stop. They mean the same value, and tell where in a clause it is shown."""
    made = []
    for p in patterns:
        own, near = "|".join(p.words), _BESIDE[p.locale].split()
        beside = "|".join(near)
        pairs = tuple(k for w in p.words for n in near for k in (f"{w} {n}", f"{n} {w}"))
        made.append(Pattern(p.dimension, p.value, p.locale, f"{p.id}-pair", p.words, rf"(?:^|[^\p{{L}}])(?:(?:{own}) +(?:{beside})|(?:{beside}) +(?:{own}))(?:[^\p{{L}}]|$)", pairs))
        made.append(Pattern(p.dimension, p.value, p.locale, f"{p.id}-ending", p.words, rf"(?:^|[^\p{{L}}])(?:{own})[,.] ", tuple(f"{w}." for w in p.words)))
    return checked(made)
