"""Keys and clean forms of channel names and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import LOWER, SQUEEZE, UNACCENT, UNESCAPE, UPPER, Step, apply

# ---- fixed values: marks of quality, top-level domains, prefixes of generated identifiers, federal units ----
QUALITY = (
    "SD", "FHDR", "FHD", "HDR", "UHD", "HD", "4K", "8K", r"H\.?264", r"H\.?265", "HEVC", "AVC", "1080P", "1080I", "720P", "60FPS", r"BR\d*", r"SRV\d*",
    r"SERVER\s*\d*", r"OPCAO\s*\d*", r"OP\d*", "ALT", "ALTERNATIVO", "BACKUP", "BKP", "LOW", "MED", "HIGH", r"PLUS\s*HD", "HQ", "P", "1X",
)
PLAIN_QUALITY = ("HD", "FHD", "FULLHD", "UHD", "4K", "8K", "SD", "CHANNEL", "H264", "H265", "H266", "HEVC", "AVC", "HDR", "HDR10", "HDR10PLUS", "DV", "DOLBYVISION",
                 "FPS", r"\d{2,3}FPS", "VIP", "BACKUP", "BKP", "ALT", "TESTE", "TEST", "RAW", "LEG")
DOMAINS = "br|us|uk|pt|ar|mx|cl|co|pe|ca|latam|int|bt"
#: Numbers that belong to marks of quality and to servers, not to a channel.
NUMBER_MARKS = (r"H\.?264", r"H\.?265", "1080[PI]?", "720P?", "60FPS", "4K", "8K", "24HS?", "24/7", r"BR\d+", r"SRV\d+", r"SERVER\s*\d+", r"OP\d+", "1X")
UFS = ("AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA", "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO")
COUNTRIES = ("PT", "US", "USA", "UK", "CO", "ARG", "AR", "MX", "EC", "PY", "UY", "CL", "PE", "BOL", "VEN", "DE", "ES", "FR", "IT", "CA", "JP")
STOP_WORDS = ("TV", "DE", "DO", "DA", "DOS", "DAS", "E")

# ---- fixed values: the ordered steps of the keys, since catalogs and lists in use hold keys that were made by them ----
#: Comparison key: domain, quality, accents and marks dropped, numbers in brackets kept, leading zeros dropped.
NAME_KEY: tuple[Step, ...] = (
    UNESCAPE, (rf"(?i)\.(?:{DOMAINS})$", " "), (r"(?i)([A-Za-z0-9])(4K|8K|UHD|FHDR|FHD|SD)\b|([A-EG-Za-eg-z0-9])(HD)\b", r"\1\3 \2\4"),
    (r"(?i)([A-Za-z0-9])(?:BR\d+|SRV\d+|OP\d+)\b", r"\1 "), (r"[¹²³⁴⁵⁶⁷⁸⁹⁰ᴴᴰ]+", " "), UNACCENT, UPPER,
    (r"\[\s*(\d+)\s*\]", r" \1 "), (r"\[[^\]]*\]", " "), (r"\*+", " "), (r"&", " AND "), (r"[()\-–—_./|,:;]", " "),
    (rf"\b(?:{'|'.join(QUALITY)})\b[*+]*", " "), (r"[^A-Z0-9+ ]", " "), (r"\b0+(\d+)\b", r"\1"), (r"\s+F$", ""), SQUEEZE,
)
#: The simpler key that drops everything in brackets.
NAME_KEY_SIMPLE: tuple[Step, ...] = (
    UNESCAPE, (r"[¹²³⁴ᴴᴰ]+", " "), UNACCENT, UPPER, (r"\[[^\]]*\]", " "), (r"\*+", " "), (r"&", " AND "), (r"[()\-–—_./|,:;]", " "),
    (r"\b(?:SD|HD|FHD|UHD|4K|8K|H\.?264|H\.?265|HEVC|BR2|P)\b[*+]*", " "), (r"[^A-Z0-9+ ]", " "), SQUEEZE,
)
#: Quality marks dropped, the rest kept as written.
QUALITY_STRIP: tuple[Step, ...] = (
    UNESCAPE, (r"[⁰¹²³⁴⁵⁶⁷⁸⁹ᴴᴰ]", ""), (r"\s*\(\s*\d+\s*\)\s*$", ""),
    (r"(?i)\[\s*(?:H\s*\.?\s*26[456]|HEVC|AVC|HD|FHD|FULL\s*HD|UHD|4K|8K|SD|HDR(?:10)?\s*\+?|\d+\s*FPS|LEG)\s*\]", " "), (r"(?i)\bH\s*\.?\s*26[456]\b", " H265 "),
    (r"\+", " PLUS "), (r"(?i)\bFULL[\s._/|:-]+HD\b", " "), (r"(?i)\bFULL\b", " "), (rf"(?i)\b(?:{'|'.join(PLAIN_QUALITY)})\b", " "), (r"[\s._/|:-]+", " "), SQUEEZE,
)
#: Letters and digits only, of the name without quality marks.
NORM_NAME: tuple[Step, ...] = (
    *QUALITY_STRIP, UNACCENT, UPPER, (r"[\s._/-]+BR$", ""), (r"^A\s*(?:&|AND|E)\s*E$", "AANDE"), (r"&", " AND "), (r"[^A-Z0-9]+", ""),
)
#: A feed's identifier: what stands after the last "..", without country and domain.
SOURCE_ID: tuple[Step, ...] = (
    UNESCAPE, (r"(?i)\s*\((?:SRC\d+|SOURCE\d*)\)\s*$", ""), (r"^.*\.\.([^.]*[A-Za-z].*)$", r"\1"), (r"(?i)(^|[./_-])(?:BR|BRAZIL)($|[./_-])", " "), (r"(?i)\.(?:BR|COM|NET|ORG)$", ""), *NORM_NAME,
)
ID_KEY: tuple[Step, ...] = (LOWER, (rf"\.(?:{DOMAINS})$", ""), (r"^(?:auto|yt|br|canais)\.", ""), (r"[^a-z0-9]", ""))
SAFE_ID: tuple[Step, ...] = (UNESCAPE, UNACCENT, (r"&", "And"), (r"\+", "Plus"), (r"!", ""), (r"[\"'<>:;]+", ""), SQUEEZE, (r"\s+", "."))
PLAIN_KEY: tuple[Step, ...] = (UNACCENT, UPPER, (r"[^A-Z0-9]+", ""))


def name_key(c: Column) -> Column:
    return apply(c, NAME_KEY)


def name_key_simple(c: Column) -> Column:
    return apply(c, NAME_KEY_SIMPLE)


def strip_quality(c: Column) -> Column:
    return apply(c, QUALITY_STRIP)


def norm_name(c: Column) -> Column:
    return apply(c, NORM_NAME)


def source_id(c: Column) -> Column:
    return apply(c, SOURCE_ID)


def id_key(c: Column) -> Column:
    return apply(c, ID_KEY)


def plain_key(c: Column) -> Column:
    return apply(c, PLAIN_KEY)


def digits(c: Column) -> Column:
    """Digit runs of a normalised name, joined by commas: the block key of fuzzy matching."""
    return F.array_join(F.regexp_extract_all(c, F.lit(r"(\d+)"), 1), ",")


def significant_numbers(c: Column) -> Column:
    """Channel numbers of a name without those of quality marks and without leading zeros, joined by commas."""
    t = apply(c, (UNESCAPE, UPPER, (rf"\b(?:{'|'.join(NUMBER_MARKS)})\b", " "), (r"[¹²³⁴⁵⁶⁷⁸⁹⁰]+", " ")))
    return F.array_join(F.transform(F.regexp_extract_all(t, F.lit(r"(\d+)"), 1), lambda d: F.regexp_replace(d, r"^0+(\d)", "$1")), ",")


def is_safe_id(c: Column) -> Column:
    """Without blanks, accents and marks that players choke on."""
    return c.isNotNull() & (F.trim(c) != "") & ~F.trim(c).rlike(r"[\s&!+\"'<>;]") & (F.translate(c, MARKED_LETTERS, BARE_LETTERS) == c)


def safe_id(c: Column, canonical: dict[str, str] | None = None) -> Column:
    """An identifier as it is if it is safe, else made safe; ``canonical`` maps names in capitals to fixed identifiers."""
    made = apply(c, SAFE_ID)
    made = F.when(made.endswith(".br"), made).otherwise(F.lower(made))
    kept = F.when(is_safe_id(c), F.trim(c)).otherwise(made)
    if not canonical:
        return kept
    table = F.create_map(*(F.lit(x) for kv in canonical.items() for x in kv))
    return F.coalesce(table[F.upper(F.trim(c))], kept)


def country(c: Column) -> Column:
    """Code of the foreign country a name begins with, '' for none; USA is US and AR is ARG."""
    t = apply(c, (UNESCAPE, UPPER, (r"^[^A-Z0-9]+", "")))
    code = F.regexp_extract(t, rf"^({'|'.join(sorted(COUNTRIES, key=len, reverse=True))})\b", 1)
    return F.when(t.rlike(r"^USA (?:NETWORK|HD|FHD|SD|UHD|4K)\b"), "").when(code == "USA", "US").when(code == "AR", "ARG").otherwise(code)


def states(c: Column, places: dict[str, str] | None = None) -> Column:
    """Sorted federal units that a name's key holds as words; ``places`` maps further words, and those of six letters or
    more also within the key without blanks, to their unit."""
    words = F.array_distinct(F.split(name_key(c), " "))
    found = F.array_intersect(words, F.array(*(F.lit(u) for u in UFS)))
    if places:
        table = F.create_map(*(F.lit(x) for kv in places.items() for x in kv))
        joined = F.regexp_replace(name_key(c), " ", "")
        long = F.array(*(F.when(F.contains(joined, F.lit(k)), F.lit(v)) for k, v in places.items() if len(k) >= 6))
        found = F.array_compact(F.array_distinct(F.concat(found, F.transform(words, lambda w: table[w]), long)))
    return F.array_sort(found)


def number_conflict(a: Column, b: Column) -> Column:
    return significant_numbers(a) != significant_numbers(b)


def region_conflict(a: Column, b: Column) -> Column:
    """Different countries, or states of which none is common."""
    return (country(a) != country(b)) | ((F.size(states(a)) > 0) & (F.size(states(b)) > 0) & ~F.arrays_overlap(states(a), states(b)))


def token_set(c: Column) -> Column:
    """Sorted words of a key without stop words, joined by blanks."""
    return F.array_join(F.array_sort(F.array_distinct(F.array_except(F.split(c, " "), F.array(*(F.lit(w) for w in (*STOP_WORDS, "")))))), " ")


def camel_id(c: Column) -> Column:
    """Capitalised words joined, with the country's domain."""
    words = F.regexp_extract_all(apply(c, (UNESCAPE, UNACCENT)), F.lit(r"([A-Za-z0-9]+)"), 1)
    return F.concat(F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, F.lit(2), F.length(w))))), ""), F.lit(".br"))


def automatic_id(c: Column) -> Column:
    return F.concat(F.lit("auto."), F.lower(F.when(norm_name(c) == "", "canal").otherwise(norm_name(c))))


from .rules import BARE as BARE_LETTERS  # noqa: E402
from .rules import MARKED as MARKED_LETTERS  # noqa: E402


#: Ordered rewrites of names that changed or are often mistyped: pattern, replacement. A parameter of ``rewritten``.
REWRITES: tuple[Step, ...] = (
    (r"\bNOTICIARIO\b", "NOTICIAS"), (r"\bESPORTE\b", "ESPORTES"), (r"\bREDE TV!?\b", "REDETV"), (r"\bAGRO ?(?:\+|PLUS|MAIS)", "AGROMAIS"), (r"\b(?:CANAL|REDE) ", ""), (r"\bTV ([A-Z]{4,})\b", r"\1"),
)


def rewritten(c: Column, rules: tuple[Step, ...] = REWRITES) -> Column:
    """The clean name in capitals after the ordered rewrites; foreign names are left as they are."""
    plain = apply(c, (*QUALITY_STRIP, UNACCENT, UPPER))
    return F.when(country(c) != "", plain).otherwise(apply(plain, (*rules, SQUEEZE)))


def with_network(name: Column, group: Column, networks: tuple[str, ...]) -> Column:
    """The name with its group's network before it, if the name holds no network of its own."""
    n, g = apply(name, (UNACCENT, UPPER)), apply(F.coalesce(group, F.lit("")), (UNACCENT, UPPER))
    out = F.when(F.exists(F.array(*(F.lit(x) for x in networks)), lambda x: F.contains(n, x)), n)
    for x in networks:
        out = out.when(F.contains(g, F.lit(x)), F.concat(F.lit(x + " "), n))
    return out.otherwise(n)


def compound_candidates(c: Column) -> Column:
    """Names that an identifier 'City/UF..Network.Rest.br' may stand for: the right part, and its network with the city."""
    right = F.regexp_replace(F.regexp_replace(F.regexp_extract(c, r"^.*?\.\.(.*)$", 1), rf"(?i)\.(?:{DOMAINS})$", ""), r"[.\-–—_]+", " ")
    place = F.trim(F.regexp_replace(F.regexp_extract(c, r"^(.*?)\.\.", 1), r"[./]", " "))
    city = F.trim(F.regexp_replace(F.regexp_extract(c, r"^([^/]*?)(?:/.*)?\.\.", 1), r"\.", " "))
    network = F.regexp_extract(right, r"^(\S+)", 1)
    made = F.array(F.trim(right), F.concat_ws(" ", network, place), F.concat_ws(" ", network, city))
    return F.when(F.contains(c, F.lit("..")), F.array_distinct(F.filter(made, lambda x: F.trim(x) != ""))).otherwise(F.array().cast("array<string>"))
