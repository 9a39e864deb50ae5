"""Parts of a channel's name: brand, genre and number, or network and town.

Genres and networks are learned from a dictionary. A word that ends the names of many different brands, more than those
brands have words of their own, is a genre; what aliases write in its place is a form of it. Networks are the words
before the last one in names without a genre. General genre words are known beforehand, for dictionaries too small to
learn from. Names of several words without a genre and a known network keep their words in order of the alphabet, as
either may come first.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable
from typing import NamedTuple

#: General genre words in Portuguese and English with their short forms; the first is the genre's name.
GENRES = (
    ("nature", "natureza", "nat"), ("kids", "infantil", "inf", "kid"), ("music", "musica", "mus"), ("agro", "rural", "rur", "agr"), ("arts", "cultura", "cult", "art"),
    ("series", "serie", "ser"), ("news", "noticias", "not", "new"), ("sports", "esportes", "esp", "spo"), ("family", "familia", "fam"), ("movies", "filmes", "film", "mov"),
    ("documentary", "documentarios", "documentario", "doc", "docs"), ("comedy", "comedia", "humor"), ("cooking", "culinaria", "gourmet"), ("travel", "viagem", "turismo"), ("science", "ciencia"),
    ("business", "negocios", "economia"), ("religion", "religioso", "religiosa"), ("education", "educacao", "educativa"), ("fashion", "moda"), ("health", "saude"), ("games", "jogos"), ("weather", "clima"), ("anime", "animes"),
)
#: A word is learned as a genre if it ends names of so many brands, and this often as many as those brands have genres.
GENRE_BRANDS, GENRE_WIDTH = 8, 2.0
#: A form is learned if so many entries write it.
FORM_ENTRIES = 2
#: Marks of quality and words around names.
QUALITY = frozenset("hd hd2 fhd uhd sd 4k 8k h264 h265 hevc full 1080p 720p alt backup opcao option".split())
AROUND = frozenset("tv rede canal channel br bra brasil auto epg id ch c canais com net org png jpg".split())
#: The federal units.
STATES = frozenset("ac al ap am ba ce df es go ma mt ms mg pa pb pr pe pi rj rn rs ro rr sc sp se to".split())

_GENRE = {w: g[0] for g in GENRES for w in g}
#: Short forms that a brand written together with them ends in.
_CLIPPED = ("cult", "film", "nat", "inf", "kid", "mus", "rur", "agr", "ser", "not", "esp", "fam", "mov")
_LONG = sorted((w for w in _GENRE if len(w) >= 5 or w in ("kids", "news", "arts", "cult", "film")), key=len, reverse=True)
_VOD = re.compile(r"\bs\d{1,2} ?e\d{1,4}\b|\((?:19|20)\d\d\)|\bt\d{1,2} ?ep ?\d+", re.I)
_FOREIGN = re.compile(r"^\W*([A-Za-z]{2})\W*\s?[|:\-–]\s")
_CAMEL = re.compile(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Ý])|(?<=[^\W\d_]{3})(?=\d)|(?<=\d)(?=[^\W\d_]{3})")
_ZERO = re.compile(r"(?<=[^\W\d_])0(?![\d])|(?<![\w])0(?=[^\W\d_]{3})")


class Parts(NamedTuple):
    core: str
    genre: str
    number: str
    network: str
    foreign: bool
    vod: bool
    bracketed: bool = False  # the number stands in brackets and may count streams

    @property
    def key(self) -> str | None:
        """What tells channels apart, if the name says it all."""
        if self.core and (self.genre or (self.core != self.network and " " in self.core)):
            return f"{self.core}|{self.genre}|{self.number}"
        return None


def fold(text: str) -> str:
    t = unicodedata.normalize("NFKD", text)
    return "".join(c for c in t if not unicodedata.combining(c))


def deletions(word: str) -> set[str]:
    return {word[:i] + word[i + 1:] for i in range(len(word))} | {word}


def near(a: str, b: str, most: int = 1) -> bool:
    """Optimal string alignment distance of at most ``most``."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > most:
        return False
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if before and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        before, last = last, row
        if min(last) > most:
            return False
    return last[-1] <= most


class Parser:
    """dictionary_names, and the aliases of each in the same order, are what genres and networks are learned from."""

    def __init__(self, dictionary_names: Iterable[str] = (), aliases: Iterable[Iterable[str] | None] = ()):
        self.genre, self.long, self.clipped = dict(_GENRE), list(_LONG), list(_CLIPPED)
        entries = [[w for w in self._tokens(fold(n or ""))[0] if not w.isdigit()] for n in dictionary_names]
        self._learn_genres(entries, list(aliases))
        self.networks: set[str] = {" ".join(w[:-1]) for w in entries if len(w) >= 2 and not any(x in self.genre for x in w)}
        self._joined = {n.replace(" ", ""): n for n in sorted(self.networks)}
        self._widest = max(map(len, self._joined), default=0)
        self._spans = max((len(n.split()) for n in self.networks), default=0)
        self._codes = {n[:3]: self._joined[n] for n in sorted(self._joined, reverse=True)} | self._joined
        self._longest = 1 + max((len(w) for w in (*self.genre, *self.networks)), default=0)
        self._near = {d: w for w in sorted(set(self.genre) | {n for n in self.networks if " " not in n}) if len(w) >= 5 for d in deletions(w)}

    def _learn_genres(self, entries: list[list[str]], aliases: list) -> None:
        brands, own = defaultdict(set), defaultdict(set)
        for w in entries:
            if len(w) >= 2:
                brands[w[-1]].add(" ".join(w[:-1]))
                own[" ".join(w[:-1])].add(w[-1])
        wide = {t for t, b in brands.items() if len(b) >= GENRE_BRANDS and len(b) * len(b) >= GENRE_WIDTH * sum(len(own[x]) for x in b)}
        forms = defaultdict(Counter)
        for w, others in zip(entries, aliases):
            if len(w) >= 2 and w[-1] in wide:
                for a in {" ".join(x for x in self._tokens(fold(t or ""))[0] if not x.isdigit()) for t in (others if others is not None else ())}:
                    rest = Counter(a.split()) - Counter(w[:-1])
                    if len(a.split()) == len(w) and rest.total() == 1:
                        forms[w[-1]].update(rest)
        for t in sorted(wide):
            name = self.genre.get(t, t)
            for f in [t, *(f for f, n in sorted(forms[t].items()) if n >= FORM_ENTRIES)]:
                if f not in self.genre:
                    self.genre[f] = name
                    if len(f) >= 4:
                        self.long.append(f)
                    if len(f) in (3, 4) and t.startswith(f):
                        self.clipped.append(f)
        self.long.sort(key=len, reverse=True)

    @staticmethod
    def _tokens(text: str) -> tuple[list[str], list[bool]]:
        """Words in small letters without the words around names, and whether a mark of quality stands before each."""
        words, after, seen = [], [], False
        t = _CAMEL.sub(" ", _ZERO.sub("o", text))
        raw = re.findall(r"[^\W_]+", t.lower())
        ends = max((i for i, w in enumerate(raw) if w not in QUALITY), default=0)
        for i, w in enumerate(raw):
            if w in QUALITY:
                seen = True
            elif w in AROUND or (w in STATES and i == ends and i) or (len(w) == 2 and w in STATES and i and (raw[i - 1] in AROUND or raw[i - 1] in _GENRE)):
                continue
            else:
                words.append(w)
                after.append(seen)
        return words, after

    def _word(self, w: str) -> str:
        """The genre word or network of which w is a slip, or w."""
        if w in self.genre or w in self.networks or not 5 <= len(w) <= self._longest:
            return w
        hit = next((self._near[d] for d in sorted(deletions(w), key=len, reverse=True) if d in self._near), None)
        return hit if hit and near(w, hit) else w

    def _split(self, w: str) -> list[str]:
        """A word in which brand and genre, or network and town, are written together."""
        if w in self.genre or w in self.networks or len(w) < 9:
            return [w]
        for g in self.long:
            if w.endswith(g) and len(w) - len(g) >= 5:
                return [w[: -len(g)], g]
        for g in self.clipped:
            if w.endswith(g) and len(w) - len(g) >= 7 and w[-len(g) - 1] in "aeiou":
                return [w[: -len(g)], g]
        for k in range(min(len(w) - 5, self._widest), 0, -1):
            if w[:k] in self._joined:
                return [*self._joined[w[:k]].split(), w[k:]]
            if w[-k:] in self._joined:
                return [*self._joined[w[-k:]].split(), w[:-k]]
        return [w]

    def _network_in(self, words: list[str], least: int = 1) -> tuple[int, int] | None:
        """Start and end of the longest network among the words."""
        spans = [(i, j) for i in range(len(words)) for j in range(i + least, min(i + self._spans, len(words)) + 1) if " ".join(words[i:j]) in self.networks]
        return max(spans, key=lambda x: (len(" ".join(words[x[0]:x[1]])), -x[0]), default=None)

    def parse(self, name: str | None) -> Parts:
        text = fold(name or "")
        vod = bool(_VOD.search(text))
        m = _FOREIGN.match(text)
        foreign = bool(m) and m.group(1).lower() != "br" and m.group(1).lower() != "tv"
        if foreign:
            text = text[m.end():]
        tokens, after = self._tokens(text)
        genre, number, rest = "", "", []
        for w, late in zip(tokens, after):
            if w.isdigit():
                if not number and not late:
                    number = str(int(w))
                continue
            for x in self._split(w):
                x = self._word(x)
                if x in self.genre and not genre and (len(tokens) > 1 or x != w):
                    genre = self.genre[x]
                else:
                    rest.append(x)
        if genre and not rest:
            rest, genre = [genre], ""
        network = ""
        if not genre:
            if at := self._network_in(rest):
                network = " ".join(rest[at[0]:at[1]])
                rest = [network, *rest[:at[0]], *rest[at[1]:]]
            if not network:
                rest.sort()
        return Parts(" ".join(rest), genre, number, network, foreign, vod, bool(number) and bool(re.search(rf"[\[(]0*{number}[\])]", text)))

    def parse_code(self, code: str | None) -> list[Parts]:
        """An identifier or the name of an image; both readings where a short form may be a genre or a network."""
        text = fold(code or "")
        if re.fullmatch(r"(?:[A-Za-z]{1,3}[._-]?)?\d+", text):
            return []
        text = re.sub(r"^(?:logos|img|thumb|s\d+)/|\.(?:png|jpg|svg)$|@\w+$|\.(?:br|canal|tv)$", "", text, flags=re.I)
        text = re.sub(r"^tv(?=[A-Za-z])", "", text)
        text = re.sub(r"^([A-Za-z]+)/([A-Za-z]{2})\.\.", r"\1 ", text)
        text = re.sub(r"([A-Za-z]+)/[A-Z]{2}(?=\.\.)", r"\1 ", text)
        words: list[str] = []
        for w in re.findall(r"[^\W\d_]+|\d+", _CAMEL.sub(" ", text)):
            words += self._split(w.lower())
        if at := self._network_in(words, 2):
            words[at[0]:at[1]] = ["".join(words[at[0]:at[1]])]
        networks = self._codes
        out = []
        for first in ("genre", "network"):
            genre, number, network, rest = "", "", "", []
            for w in words:
                if w.isdigit():
                    number = number or str(int(w))
                elif w in AROUND or w in QUALITY:
                    continue
                elif w in self.genre and not genre and not network and (first == "genre" or w not in networks):
                    genre = self.genre[w]
                elif w in networks and not network and not genre:
                    network = networks[w]
                else:
                    rest.append(w)
            if genre or network or len(rest) > 1:
                if not genre and not network:
                    rest.sort()
                out.append(Parts(" ".join(([network] if network else []) + rest), genre, number, network, False, False))
        return list(dict.fromkeys(out))
