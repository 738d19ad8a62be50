"""Line-first cleaning: lines fail punctuation, navigation or boilerplate rules; documents that lose too much go.

Every rule is a pure function of one line, so whole texts run through a map without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"
#: Phrases (lower case) of notices and page furniture in English, German, French and Spanish; fixed values of the boilerplate rule.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "we use cookies", "accept all cookies", "privacy policy", "terms of service", "terms of use",
    "subscribe to our newsletter", "sign up for our newsletter", "click here to", "enable javascript", "licensed under the", "skip to content",
    "alle rechte vorbehalten", "datenschutzerklärung", "datenschutz |", "nutzungsbedingungen", "cookie-richtlinie", "wir verwenden cookies",
    "newsletter abonnieren", "zum inhalt springen", "klicken sie hier",
    "tous droits réservés", "politique de confidentialité", "conditions d'utilisation", "mentions légales", "nous utilisons des cookies",
    "abonnez-vous à notre newsletter", "aller au contenu", "cliquez ici",
    "todos los derechos reservados", "política de privacidad", "términos de uso", "condiciones de uso", "aviso legal", "utilizamos cookies",
    "suscríbete a nuestro boletín", "saltar al contenido", "haga clic aquí",
)
#: Entries (lower case) of site menus in the same languages; fixed values of the navigation rule.
MENU = frozenset(
    """home about contact login logout register search news blog shop cart basket help faq faqs sitemap menu account profile products services
    support careers jobs press downloads forum archive categories tags next previous back top more share subscribe sign in up us
    startseite über kontakt anmelden abmelden registrieren suche suchen nachrichten warenkorb hilfe konto produkte leistungen karriere presse
    impressum datenschutz agb weiter zurück mehr teilen uns
    accueil propos connexion déconnexion inscription recherche rechercher actualités boutique panier aide compte produits carrières
    suivant précédent retour plus partager nous
    inicio acerca contacto entrar salir registro registrarse buscar noticias tienda carrito ayuda cuenta productos servicios empleo
    siguiente anterior volver más compartir nosotros""".split()
)
#: Separators that stand alone between the entries of menus and bread crumbs.
SEPARATORS = ("|", ">", "»", "/", "•", "·")
LONG_LINE_WORDS = 20
MAX_LOST = 0.5
#: Characters that end sentences, in every script (the Unicode property and Tibetan's strokes), and four marks of their kind.
SENTENCE_MARKS = "".join(sorted(set(regex.findall(r"[\p{STerm}\u0F0D-\u0F11]", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x20000)])))) | set(":;…：")))
#: Scripts that write sentences without a mark (Thai, Lao).
UNMARKED = r"\u0E00-\u0EFF"
_SENTENCE, _UNMARKED = regex.compile(f"[{regex.escape(SENTENCE_MARKS)}]"), regex.compile(f"[{UNMARKED}]")
_CAPITAL = regex.compile(r"\p{Lu}")
#: Phrases of a boilerplate line make up at least one word in this many.
PHRASE_SHARE = 5
_PHRASE_WORDS = [(p, len(p.split())) for p in BOILERPLATE]


def line_verdict(line: str) -> str | None:
    """The first rule that a line fails: navigation, punctuation, boilerplate; None if it passes (blank lines do).

    navigation: at least three lone separators, and one for every four other words or more; or four entries or more
    of at most three words, parted by tabs, without a sentence mark; or at most 15 words, without a sentence mark,
    of which three or more and at least two thirds are menu entries; or 5 to 15 words without a sentence mark, at least
    four in five with a capital and one a menu entry, as menus of other languages have it;
    punctuation: symbols or exclamation marks end at least 30 % of 5 words or more, or a line of 20 words or more
    has no sentence mark of any script, unless half of it is in a script that has none;
    boilerplate: at most 40 words, of which known phrases make up at least one in five.
    """
    words = line.split()
    if not words:
        return None
    n = len(words)
    alone = sum(map(words.count, SEPARATORS))
    if alone >= 3 and 4 * alone >= n - alone:
        return "navigation"
    if n >= 3 and (n <= 15 or "\t" in line) and not _SENTENCE.search(line):
        entries = [e.split() for e in line.strip().split("\t") if e.strip()]
        if len(entries) >= 4 and max(map(len, entries)) <= 3:
            return "navigation"
        known = sum(w.lower() in MENU for w in words)
        if n <= 15 and known >= 3 and 3 * known >= 2 * n:
            return "navigation"
        if 5 <= n <= 15 and known and 5 * sum(bool(_CAPITAL.match(w)) for w in words) >= 4 * n:
            return "navigation"
    odd = sum(w[-1] in SYMBOLS or w.endswith("!!") for w in words)
    if n >= 5 and 10 * odd >= 3 * n:
        return "punctuation"
    if n >= LONG_LINE_WORDS and not _SENTENCE.search(line) and 2 * len(_UNMARKED.findall(line)) < sum(map(len, words)):
        return "punctuation"
    if n <= 40:
        low = line.lower()
        if PHRASE_SHARE * sum(k for p, k in _PHRASE_WORDS if p in low) >= n:
            return "boilerplate"
    return None


def n_repeat_words(words: list[bytes], width: int = 8) -> int:
    """Words inside windows of ``width`` words that the text has twice or more, the first included.

    Words are numbered by value and windows by the numbers of two shorter windows that cover them, so equal numbers
    are equal words and nothing is hashed.
    """
    n, seen = len(words), {}
    number = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    if n <= width or len(seen) == n:
        return 0
    have = 1
    while have < width:
        step = min(have, width - have)
        left, right = number[: len(number) - step], number[step:]
        number = np.unique(left * (int(number.max()) + 1) + right, return_inverse=True)[1]
        have += step
    at = np.flatnonzero(np.bincount(number)[number] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measure(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines lost by rule, words kept, cleaned text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # the bytes 0x20 and 0x09-0x0D part words
    chars = len(b"".join(words).decode("utf-8", "surrogatepass"))
    symbols = sum(map(text.count, SYMBOLS))
    seen, dup, lost, kept, kept_words = set(), 0, {"punctuation": 0, "navigation": 0, "boilerplate": 0}, [], 0
    for line in text.split("\n"):
        n = len(line.encode("utf-8", "surrogatepass").split())
        if n:
            dup += line in seen
            seen.add(line)
        rule = line_verdict(line)
        if rule:
            lost[rule] += 1
        else:
            kept.append(line)
            kept_words += n
    clean = text if not any(lost.values()) else "\n".join(kept)
    return len(words), chars, symbols, dup, n_repeat_words(words), *lost.values(), kept_words, clean


_NEW = (
    ("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint"),
    ("punctuation_lines", "bigint"), ("navigation_lines", "bigint"), ("boilerplate_lines", "bigint"), ("n_kept_words", "bigint"), ("clean_text", "string"),
)


def clean_lines(docs: DataFrame, *, text_col: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """All columns of ``docs`` (those with an output's name are replaced) plus counts, ``clean_text`` and verdicts.

    ``base_failed``: fewer than 20 words, or over 30 % of the words in 8-word windows that come back. ``kept``: not
    base_failed and at most ``max_lost`` of the words stood on removed lines. Null and empty texts have no words and
    fail. Rows are judged one by one, so repeated rows agree.
    """
    outputs = [n for n, _ in _NEW] + ["base_failed", "kept"]
    docs = docs.drop(*outputs)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                values = list(zip(*[measure(t) for t in part.column(text_col).to_pylist()], strict=True))
                made = [pa.array(v, pa.string() if kind == "string" else pa.int64()) for v, (_, kind) in zip(values, _NEW, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*columns, *[n for n, _ in _NEW]])

    schema = docs.withColumns({n: F.lit(None).cast(kind) for n, kind in _NEW}).schema
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    lost = F.col("n_words") - F.col("n_kept_words") > max_lost * F.col("n_words")
    return docs.mapInArrow(run, schema).withColumn("base_failed", failed).withColumn("kept", ~failed & ~lost)
