"""Scalar text and parsing expressions (``Column -> Column``).

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation. The only Python path is ``fold_accents_exact``, an
Arrow-batched pandas UDF kept for exact Unicode NFKD.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Python's str.strip() whitespace that can occur in text files.
WHITESPACE = " \t\n\r\x0b\x0c"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nan_to_null(col) -> Column:
    """NaN -> null (pandas treats NaN as missing; Spark ranks it above all numbers)."""
    c = _c(col)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def parse_fr_number(col) -> Column:
    """B3: '250 000,50' -> 250000.5; bad text -> null. Never raises under ANSI."""
    c = F.coalesce(_c(col).cast("string"), F.lit(""))
    cleaned = F.replace(F.replace(c, F.lit(" "), F.lit("")), F.lit(","), F.lit("."))
    return nan_to_null(_try_double(cleaned))


def _try_double(c: Column) -> Column:
    return c.try_cast("double")


def parse_date_strict(col, day_first_format: str = "dd/MM/yyyy") -> Column:
    """Strict day-first date; '1/2/2020' is also accepted (as pandas does)."""
    c = _c(col)
    return F.coalesce(F.try_to_date(c, day_first_format), F.try_to_date(c, "d/M/yyyy"))


# Formats tried in order by the lenient parser (ISO first).
LENIENT_DATE_FORMATS = (
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy/MM/dd",
    "dd/MM/yyyy",
    "d/M/yyyy",
    "yyyyMMdd",
)


def parse_date_lenient(col, formats=LENIENT_DATE_FORMATS) -> Column:
    """First format that parses wins; nothing parses -> null."""
    c = F.trim(_c(col).cast("string"))
    return F.coalesce(*[F.try_to_date(c, fmt) for fmt in formats])


def split_lat_lon(col) -> tuple[Column, Column]:
    """B7: 'lat, lon' -> (lat, lon). Both null unless there are exactly two
    parts and both parse as numbers."""
    parts = F.split(_c(col), ",")
    ok = F.size(parts) == 2
    lat = _try_double(F.trim(F.try_element_at(parts, F.lit(1)), F.lit(WHITESPACE)))
    lon = _try_double(F.trim(F.try_element_at(parts, F.lit(2)), F.lit(WHITESPACE)))
    both = ok & lat.isNotNull() & lon.isNotNull()
    null = F.lit(None).cast("double")
    return F.when(both, lat).otherwise(null), F.when(both, lon).otherwise(null)


def yes_no(col, yes_word: str = "interconnexion", no_word: str = "non") -> Column:
    """Trim + lower, then yes_word -> 'oui', no_word -> 'non', else null."""
    c = F.lower(F.trim(_c(col), F.lit(WHITESPACE)))
    return F.when(c == yes_word, "oui").when(c == no_word, "non").otherwise(F.lit(None).cast("string"))


def remove_spaces(col) -> Column:
    """B10."""
    return F.replace(_c(col), F.lit(" "), F.lit(""))


def lower_trim(col) -> Column:
    """B12."""
    return F.lower(F.trim(_c(col), F.lit(WHITESPACE)))


def zero_pad(col, width: int) -> Column:
    """Left-pad with zeros to ``width``; longer text is kept whole
    (a bare ``lpad`` would truncate it)."""
    c = _c(col).cast("string")
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def paris_commune_code(commune_lower, code) -> Column:
    """A lower-cased commune containing 'paris ' (numbered districts) gets
    code '056'; other rows keep their code."""
    return F.when(F.coalesce(_c(commune_lower).contains("paris "), F.lit(False)), F.lit("056")).otherwise(_c(code))


# ---------------------------------------------------------------------------
# Accent folding (B16). Spark has no Unicode normaliser, so the NFKD + "drop
# non-ASCII" rule is compiled, by rule, into a translate table over the Latin
# blocks: each letter maps to the ASCII part of its NFKD form.
# ---------------------------------------------------------------------------


def _build_fold_tables(first: int = 0x00C0, last: int = 0x024F):
    src, dst, multi = [], [], []
    for cp in range(first, last + 1):
        ch = chr(cp)
        ascii_part = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
        if len(ascii_part) == 1:
            src.append(ch)
            dst.append(ascii_part)
        elif len(ascii_part) > 1:
            multi.append((ch, ascii_part))
    return "".join(src), "".join(dst), multi


_FOLD_SRC, _FOLD_DST, _FOLD_MULTI = _build_fold_tables()


def _ascii_fold(c: Column) -> Column:
    for ch, rep in _FOLD_MULTI:
        c = F.replace(c, F.lit(ch), F.lit(rep))
    c = F.translate(c, _FOLD_SRC, _FOLD_DST)
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")


def fold_accents(col, strip_first: bool = True, null_as_empty: bool = True) -> Column:
    """Upper-case, NFKD, keep ASCII.

    ``strip_first=True`` is the address rule (strip, then fold); ``False`` is
    the commune-name rule (fold, then strip). ``null_as_empty`` returns ''
    for null input, as the address rule does.
    """
    c = F.upper(_c(col).cast("string"))
    if strip_first:
        out = _ascii_fold(F.trim(c, F.lit(WHITESPACE)))
    else:
        out = F.trim(_ascii_fold(c), F.lit(WHITESPACE))
    return F.coalesce(out, F.lit("")) if null_as_empty else out


def _fold_exact_series(s: pd.Series, strip_first: bool) -> pd.Series:
    def one(v):
        if v is None:
            return None
        v = v.upper()
        if strip_first:
            v = v.strip()
        v = unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode("ascii")
        return v if strip_first else v.strip()

    return s.map(one)


@F.pandas_udf(T.StringType())
def _fold_exact_strip_first(s: pd.Series) -> pd.Series:
    return _fold_exact_series(s, True)


@F.pandas_udf(T.StringType())
def _fold_exact_strip_last(s: pd.Series) -> pd.Series:
    return _fold_exact_series(s, False)


def fold_accents_exact(col, strip_first: bool = True) -> Column:
    """B16, exact Unicode NFKD through an Arrow-batched pandas UDF (slow path,
    for scripts beyond the Latin blocks)."""
    return (_fold_exact_strip_first if strip_first else _fold_exact_strip_last)(_c(col))


# ---------------------------------------------------------------------------
# Address key
# ---------------------------------------------------------------------------

# Fixed values that must equal the reference's: street-type abbreviation ->
# full word, in the reference's order (67 entries).
STREET_TYPES = {
    "ALL": "ALLEE", "AV": "AVENUE",
    "BD": "BOULEVARD", "BER": "BERGE", "BORD": "BORD", "CAR": "CARREFOUR",
    "CC": "CENTRE COMMERCIAL", "CD": "CHEMIN DEPARTEMENTAL", "CHE": "CHEMIN",
    "CHM": "CHEMIN", "CHS": "CHAUSSEE", "CHT": "CHALET", "CHV": "CHEMIN VICINAL",
    "CITE": "CITE", "CLOS": "CLOS", "COTE": "COTE", "COUR": "COUR",
    "CR": "CHEMIN RURAL", "CRS": "COURS", "CRX": "CROIX", "CTR": "CENTRE",
    "D": "DOMAINE", "DOM": "DOMAINE", "ESC": "ESCALIER", "ESP": "ESPLANADE",
    "FG": "FAUBOURG", "FRM": "FERME", "GAL": "GALERIE", "GPL": "GROUPE D IMMEUBLES",
    "GR": "GRANDE RUE", "HAM": "HAMEAU", "HLM": "HABITATION A LOYER MODERE",
    "IMP": "IMPASSE", "JARD": "JARDIN", "LOT": "LOTISSEMENT",
    "MAIL": "MAIL", "MTE": "MONTEE", "PKG": "PARKING", "PL": "PLACE",
    "PLA": "PLATEAU", "PLE": "PETITE LEVEE", "PONT": "PONT",
    "PORT": "PORT", "PROM": "PROMENADE", "PRV": "PARVIS",
    "PTTE": "PETITE ROUTE", "QUA": "QUARTIER", "QUAI": "QUAI",
    "RES": "RESIDENCE", "RLE": "RUELLE", "ROC": "ROCADE",
    "RTE": "ROUTE", "RUE": "RUE", "SEN": "SENTE", "SQ": "SQUARE",
    "TRA": "TRAVERSE", "TRS": "TERRASSE", "VAL": "VAL", "VALL": "VALLEE",
    "VGE": "VILLAGE", "VIL": "VILLE", "VLA": "VILLA", "VOIE": "VOIE",
    "VOIR": "VOIRIE", "VTE": "VENTE", "ZA": "ZA", "ZAC": "ZAC",
}


def street_type_map() -> Column:
    return F.create_map(*[F.lit(x) for kv in STREET_TYPES.items() for x in kv])


def expand_street_type(col) -> Column:
    """Abbreviation -> full word; unknown values are kept."""
    c = _c(col)
    return F.coalesce(F.try_element_at(street_type_map(), c), c)


def strip_dot_zero(col) -> Column:
    """Drop a trailing '.0'; null -> ''."""
    return F.regexp_replace(F.coalesce(_c(col).cast("string"), F.lit("")), r"\.0$", "")


def postcode5(col) -> Column:
    """Drop '.0', keep the first 5 characters (null stays null)."""
    c = _c(col).cast("string")
    return F.substring(F.regexp_replace(c, r"\.0$", ""), 1, 5)


def address_key(number, street, postcode) -> Column:
    """NUMBER ␠ STREET ␠ POSTCODE, upper-cased. A null part makes the
    key null (pandas would write '<NA>', which matches nothing either)."""
    return F.upper(F.concat(_c(number), F.lit(" "), _c(street), F.lit(" "), _c(postcode)))


def sale_address_key(number, street_type, street, postcode) -> Column:
    """The full sales-side key: B18(number) ␠ B16a(B17(type) ␠ street) ␠ B19(postcode)."""
    nom_voie = fold_accents(
        F.concat(F.coalesce(expand_street_type(street_type), F.lit("")), F.lit(" "),
                 F.coalesce(_c(street), F.lit(""))),
        strip_first=True,
    )
    return address_key(strip_dot_zero(number), nom_voie, postcode5(postcode))


def department_from_postcode(col) -> Column:
    """First two characters, null if shorter."""
    c = _c(col).cast("string")
    return F.when(F.length(c) >= 2, F.substring(c, 1, 2)).otherwise(F.lit(None).cast("string"))
