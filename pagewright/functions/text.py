"""Scalar functions over columns: all of them are Catalyst expressions unless said otherwise."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

PAGE_BREAK = "<!-- page break -->"

#: Fixed value: line ends other than CR LF that split lines.
LINE_ENDS = r"\r\n|[\n\r\x0B\f\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def normalize_line(line: Column) -> Column:
    """Any white space, the non-breaking kind too, as one space, none at the ends."""
    return F.trim(F.regexp_replace(line, r"(?U)[\s\x1c-\x1f]+", " "))


def split_lines(text: Column) -> Column:
    """Lines at any line end, without an empty one after the last; null stays null."""
    parts = F.split(text, LINE_ENDS, -1)
    ended = F.element_at(parts, -1) == ""
    return F.when(ended, F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def split_pages(text: Column) -> Column:
    """Pages between page-break comments; empty ones are kept."""
    return F.split(text, PAGE_BREAK, -1)


#: Accented letters and the letters they become, and letters that become two.
ACCENTED = "áàâãäåçéèêëíìîïñóòôõöøúùûüýÿÁÀÂÃÄÅÇÉÈÊËÍÌÎÏÑÓÒÔÕÖØÚÙÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinoooooouuuuyyAAAAAACEEEEIIIINOOOOOOUUUUY"
SPELLED = (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"))
#: Further Latin letters with marks, Greek and Cyrillic letters, and what they become.
FURTHER = (
    ("āăąćĉċčďđēĕėęěĝğġģĥħĩīĭįıĵķĺļľłńņňōŏőŕŗřśŝşšţťŧũūŭůűųŵŷźżžșț", "aaacccc" "dd" "eeeee" "gggg" "hh" "iiiii" "j" "k" "llll" "nnn" "ooo" "rrr" "ssss" "ttt" "uuuuuu" "w" "y" "zzz" "st"),
    ("αβγδεζηικλμνξοπρστυφωάέήίόύώς", "avgdeziiklmnxoprstyfo" "aeiioyos"),
    ("абвгдезийклмнопрстуфыэ", "abvgdeziyklmnoprstufye"),
)
FURTHER_SPELLED = (("þ", "th"), ("ð", "d"), ("θ", "th"), ("χ", "ch"), ("ψ", "ps"), ("ё", "yo"), ("ж", "zh"), ("х", "kh"), ("ц", "ts"), ("ч", "ch"), ("ш", "sh"), ("щ", "shch"), ("ъ", ""), ("ь", ""), ("ю", "yu"), ("я", "ya"))


def to_ascii(text: Column) -> Column:
    """Letters without their accents; sharp s, ligatures, Greek and Cyrillic spelled out."""
    both = [("".join(x) + "".join(x).upper(), y + y.upper()) for x, y in FURTHER if len(x.upper()) == len(x)]
    plain = F.translate(text, ACCENTED + "".join(x for x, _ in both), PLAIN + "".join(y for _, y in both))
    for mark, spelled in SPELLED:
        plain = F.regexp_replace(plain, mark, spelled)
    rest = plain
    for mark, spelled in FURTHER_SPELLED:
        rest = F.replace(F.replace(rest, F.lit(mark), F.lit(spelled)), F.lit(mark.upper()), F.lit(spelled.capitalize()))
    return F.when(plain.rlike(r"[^\x00-\x7F]"), rest).otherwise(plain)


def normalize_filename(name: Column) -> Column:
    """ASCII, lower case, with underscores for white space and hyphens."""
    return F.lower(F.regexp_replace(to_ascii(name), r"[\s\-]", "_"))


def _hex_byte(digest: Column, byte: int) -> Column:
    return F.conv(F.substring(digest, 2 * byte + 1, 2), 16, 10).cast("int")


def uuid5(namespace: str, name: Column) -> Column:
    """The name-based UUID (version 5) of a string, from sha1."""
    prefix = F.unhex(F.lit(uuid.UUID(namespace).hex))
    digest = F.sha1(F.concat(prefix, F.encode(name, "UTF-8")))
    version = F.concat(F.lit("5"), F.substring(digest, 14, 3))
    variant = F.lower(F.lpad(F.hex(_hex_byte(digest, 8).bitwiseAND(0x3F).bitwiseOR(0x80)), 2, "0"))
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), version, F.concat(variant, F.substring(digest, 19, 2)), F.substring(digest, 21, 12))


def hash_integer(*parts: Column | str) -> Column:
    """A number from 0 to 2**32 - 1 that depends on nothing but the parts."""
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *columns)), 1, 8), 16, 10).cast("bigint")


def data_url(path: Column, content: Column) -> Column:
    """The data URL of an image by its suffix; any other suffix is an error."""
    suffix = F.lower(F.regexp_extract(path, r"\.([^.]+)$", 1))
    kind = F.when(suffix == "png", "image/png").when(suffix.isin("jpg", "jpeg"), "image/jpeg")
    body = F.regexp_replace(F.base64(content), r"[\r\n]", "")
    return F.when(kind.isNull(), F.raise_error(F.concat(F.lit("not an image suffix: "), path))).otherwise(F.concat(F.lit("data:"), kind, F.lit(";base64,"), body))


def data_url_parts(url: Column) -> Column:
    """kind ('png' or 'jpeg') and bytes of a data URL; nulls for anything else."""
    kind = F.regexp_extract(url, r"^data:image/(png|jpe?g);base64,", 1)
    good = kind != ""
    return F.struct(
        F.when(good, F.regexp_replace(kind, "^jpg$", "jpeg")).alias("kind"),
        F.when(good, F.try_to_binary(F.regexp_extract(url, r"base64,(.*)$", 1), F.lit("base64"))).alias("bytes"),
    )


def strip_reasoning(text: Column) -> Column:
    """Line ends as spaces; what stands after the end of a reasoning block, where there is one."""
    flat = F.regexp_replace(text, r"\n+", " ")
    return F.trim(F.when(F.instr(flat, "</think>") > 0, F.split_part(flat, F.lit("</think>"), F.lit(2))).otherwise(flat))


def json_payload(text: Column) -> Column:
    """From the first opening to the last closing brace of a response, or the cleaned text."""
    clean = strip_reasoning(text)
    found = F.regexp_extract(clean, r"(?s)\{.*\}", 0)
    return F.when(found != "", found).otherwise(clean)


def capitalized(text: Column) -> Column:
    """First letter upper, the rest lower."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, F.lit(2), F.length(text))))


def bounded_text(text: Column, most_tokens: int = 100_000, step: int = 50_000, per_token: int = 4) -> Column:
    """Drop step characters from the end until at most most_tokens tokens are left, a token
    counting as per_token characters."""
    over = F.greatest(F.lit(0), F.ceil((F.length(text) - F.lit(most_tokens * per_token)) / F.lit(float(step))))
    return F.substring(text, F.lit(1), F.greatest(F.lit(0), F.length(text) - over.cast("int") * step))


def utc_stamp(moment: Column) -> Column:
    """ISO 8601 to the second with Z, in a session whose zone is UTC."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def padded(values: Column, size: Column, filler: Column) -> Column:
    """An array lengthened with filler to size."""
    return F.concat(values, F.array_repeat(filler, F.greatest(F.lit(0), size - F.size(values))))


def lookup(table: Column, key: Column, default: Column) -> Column:
    """A map's value for key, or default."""
    return F.coalesce(F.try_element_at(table, key), default)


def content_hash(content: Column) -> Column:
    """SHA-256 of bytes or text."""
    return F.sha2(content, 256)
