"""Archive and member file names."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from subtlake.fixed_values import DOUBLE_QUOTES, MAX_NAME_BYTES, NBSP, SINGLE_QUOTES


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` in the plan, and computed, once however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip_disposition(name: Column, num: Column) -> Column:
    """``attachment; filename="X.(num).zip"`` -> ``X``; other names lose what they carry of that frame."""
    inner = F.coalesce(
        F.nullif(F.regexp_extract(name, r'(?s)^attachment; filename="(.*)"$', 1), F.lit("")), name
    )
    tail = F.concat(F.lit(".("), num.cast("string"), F.lit(").zip"))
    return F.when(F.endswith(inner, tail), _drop_tail(inner, tail)).otherwise(inner)


def modernise_name(name: Column) -> Column:
    """``N.x.(N).zip`` -> ``N.x.zip``; null when the name is modern already."""
    num = F.substring_index(name, ".", 1)
    tail = F.concat(F.lit(".("), num, F.lit(").zip"))
    return F.when(F.endswith(name, tail), F.concat(_drop_tail(name, tail), F.lit(".zip")))


def legacy_num(name: Column) -> Column:
    """Id of a finished result file: leading ``id.`` of a known state, else the ``.(id).zip`` suffix."""
    modern = r"^([0-9]+)\.(?:zip|not-found|dmca|not-found-dmca|dcma|not-found-dcma|.*\.zip)$"
    legacy = r"^.*\.\([0-9]*\)\.[a-z]{3}\.[0-9]+cd\.\(([0-9]+)\)\.zip$"
    return F.coalesce(
        F.nullif(F.regexp_extract(name, modern, 1), F.lit("")),
        F.nullif(F.regexp_extract(name, legacy, 1), F.lit("")),
    ).try_cast("long")


def parse_zip_name(name: Column) -> Column:
    """``title.words.(year).lang.Ncd.(num).zip`` -> struct(title, year, lang, parts, num, errors).

    ``parts`` stays text when it lacks the ``cd`` ending. Null when the name is not of that family.
    """
    chunks = F.split(name, r"\.", -1)
    at = lambda back: F.try_element_at(chunks, F.lit(-back))
    year_shape = r"^\([0-9]{0,4}\)$"
    extra_parens = (at(5) == "()") & at(6).rlike(r"^\((?:[0-9]{4}|0|)\)$")
    extra_parens = F.coalesce(extra_parens, F.lit(False))
    no_lang = F.coalesce(at(4).rlike(year_shape), F.lit(False))
    year_back = F.when(no_lang, F.lit(4)).when(extra_parens, F.lit(6)).otherwise(F.lit(5))
    year_chunk = F.try_element_at(chunks, -year_back)
    lang = F.when(no_lang, F.lit("eng")).otherwise(at(4))
    count = F.greatest(F.size(chunks) - year_back, F.lit(0))
    spaced = F.array_join(F.slice(chunks, F.lit(1), count), " ")
    title = F.trim(spaced)
    year = F.regexp_replace(year_chunk, r"[()]", "")
    counted = at(3).rlike(r"^[0-9]+cd$")
    parts = F.when(counted, F.regexp_extract(at(3), r"^0*([0-9]+?)cd$", 1)).otherwise(at(3))
    num = F.regexp_extract(at(2), r"^\(([0-9]+)\)$", 1).try_cast("long")
    tag = lambda condition, text: F.when(condition, F.lit(text))
    errors = F.array_compact(
        F.array(
            tag(extra_parens, "extra empty parens after year"),
            tag(no_lang, "missing sub_lang"),
            tag(year_chunk == "()", "empty year"),
            tag((year_chunk != "()") & (F.length(year_chunk) != 6), "invalid year"),
            tag(spaced == "", "empty movie name"),
            tag(spaced != title, "spaced movie name"),
            tag(~counted, "no 'cd' prefix in sub_numparts"),
        )
    )
    valid = (
        (at(1) == "zip") & at(2).rlike(r"^\([0-9]+\)$") & year_chunk.rlike(year_shape) & lang.rlike(r"^[a-z]{3}$")
    )
    return F.when(
        valid,
        F.struct(
            title.alias("title"), year.alias("year"), lang.alias("lang"), parts.alias("parts"),
            num.alias("num"), errors.alias("errors"),
        ),
    )


def disposition_filename(header: Column) -> Column:
    """Content-Disposition header -> struct(type, filename).

    ``filename*`` (percent-coded, UTF-8 or ISO-8859-1) wins over ``filename``; numbered continuations
    are joined in order when neither is there. Path separators in the result become ``_``.
    """
    # possessive repeats: long values must not recurse in the regex engine
    found = r';\s*([^=;\s]++)\s*+=\s*+("(?:[^"\\]++|\\.)*+"|[^;"\s]*+)'
    keys = F.transform(F.regexp_extract_all(header, F.lit(found), F.lit(1)), F.lower)
    raw = F.transform(F.regexp_extract_all(header, F.lit(found), F.lit(2)), _unquote)
    pairs = F.arrays_zip(keys.alias("k"), raw.alias("v"))
    one = lambda key: F.try_element_at(F.filter(pairs, lambda p: p["k"] == key), F.lit(1))["v"]
    pieces = F.array_sort(
        F.transform(
            F.filter(pairs, lambda p: p["k"].rlike(r"^filename\*[0-9]+\*?$")),
            lambda p: F.struct(
                F.regexp_extract(p["k"], r"\*([0-9]+)", 1).try_cast("int").alias("i"),
                F.when(F.endswith(p["k"], F.lit("*")), _percent_decoded(p["v"])).otherwise(p["v"]).alias("v"),
            ),
        )
    )
    # continuations count only up to the first hole in their numbering
    run = F.filter(pieces, lambda p, i: p["i"] == i)
    joined = F.when(F.size(run) > 0, F.array_join(F.transform(run, lambda p: p["v"]), ""))
    nonempty = lambda value: F.nullif(value, F.lit(""))
    filename = F.coalesce(
        nonempty(_percent_decoded(one("filename*"))), nonempty(one("filename")), nonempty(joined)
    )
    kind = F.lower(F.regexp_extract(header, r"^\s*([^;\s]+)", 1))
    return F.struct(kind.alias("type"), F.translate(filename, "\\/", "__").alias("filename"))


def normalise_quotes(text: Column) -> Column:
    """Typographic quotes to straight ones, no-break space to space."""
    return F.translate(
        text,
        SINGLE_QUOTES + DOUBLE_QUOTES + NBSP,
        "'" * len(SINGLE_QUOTES) + '"' * len(DOUBLE_QUOTES) + " ",
    )


def fit_filename(name: Column, limit: int = MAX_NAME_BYTES) -> Column:
    """Names over ``limit`` bytes lose their middle: equal head and tail around ``...``."""
    def cut(name: Column) -> Column:
        # a cut may split a character of up to four bytes: take the longest prefix that is whole
        heads = F.transform(
            F.sequence(F.lit(limit), F.lit(limit - 3), F.lit(-1)),
            lambda size: F.substring(F.encode(name, "UTF-8"), F.lit(1), size).cast("string"),
        )
        whole = F.get(F.filter(heads, F.is_valid_utf8), F.lit(0))
        halves = F.floor(F.length(whole) / 2).cast("int") - 1
        return bind(
            halves,
            lambda keep: F.concat(
                F.substring(name, F.lit(1), keep), F.lit("..."),
                F.substring(name, F.length(name) - keep + F.lit(1), keep),
            ),
        )

    return bind(name, lambda n: F.when(F.octet_length(n) > limit, cut(n)).otherwise(n))


def extension(name: Column) -> Column:
    """Last extension with its dot; a leading dot or a dot in a folder name starts none."""
    return F.regexp_extract(name, r"(?s)[^/.][^/]*?(\.[^./]*)$", 1)


def fix_download_extension(name: Column) -> Column:
    """Lookup form: empty name gets a default, ``.dlsubc`` -> ``.srt``, ``.txt`` -> ``.sub``."""
    name = F.when(name == "", F.lit("empty_filename.srt")).otherwise(name)
    ext = extension(name)
    base = F.regexp_replace(name, r"(?s)\.[^./]*$", "")
    return (
        F.when(ext == ".dlsubc", F.concat(base, F.lit(".srt")))
        .when(ext == ".txt", F.concat(base, F.lit(".sub")))
        .otherwise(name)
    )


def fix_extension(name: Column, fmt: Column, microdvd: Column) -> Column:
    """Repair form: the name ends in its format's extension afterwards.

    A ``.txt`` that holds frame-based text becomes ``.sub``; a ``.txt`` after the right extension is
    dropped; otherwise ``.txt`` is dropped and ``.<format>`` appended to what is left.
    """
    ends_txt = lambda n: F.endswith(n, F.lit(".txt"))
    fits = lambda ext: (ext == F.concat(F.lit("."), fmt)) | ((fmt == "ssa") & (ext == ".ass"))

    def framed(n: Column) -> Column:
        stem = _drop_tail(n, F.lit(".txt"))
        is_framed = (F.lower(F.right(n, F.lit(4))) == ".txt") & F.coalesce(microdvd, F.lit(False))
        return F.when(is_framed, F.concat(stem, F.lit(".sub"))).otherwise(n)

    def fitted(n: Column) -> Column:
        without = F.when(ends_txt(n), _drop_tail(n, F.lit(".txt"))).otherwise(n)
        chosen = bind(
            without, lambda w: F.when(fits(extension(w)), w).otherwise(F.concat_ws(".", w, fmt))
        )
        return F.when(fits(extension(n)), n).otherwise(chosen)

    named = F.when(name == "", F.concat(F.lit("empty_filename."), fmt)).otherwise(name)
    return bind(bind(named, framed), fitted)


def render_path(template: str, values: Mapping[str, Column]) -> Column:
    """Fill ``$name`` / ``${name}``; unknown names stay, ``$$`` is a dollar sign."""
    import re

    out, last = [], 0
    for found in re.finditer(r"\$(?:(\$)|(\w+)|\{(\w+)\})", template, re.ASCII):
        out.append(F.lit(template[last : found.start()]))
        last = found.end()
        name = found.group(2) or found.group(3)
        if found.group(1):
            out.append(F.lit("$"))
        elif name in values:
            out.append(values[name].cast("string"))
        else:
            out.append(F.lit(found.group(0)))
    out.append(F.lit(template[last:]))
    return F.concat(*out)


def version_key(name: Column) -> Column:
    """Sort key in version order: digit runs by value, ``~`` before the end, file extensions last.

    Compare as struct: dot class, name without its extensions, whole name, name.
    """
    ending = r"(\.[\p{L}~][\p{L}\p{N}~]*)*\z"
    stem = F.concat(F.left(name, F.lit(1)), F.regexp_replace(F.substring(name, F.lit(2), F.length(name)), ending, ""))
    dots = (
        F.when(name == "", F.lit(0)).when(name == ".", F.lit(1)).when(name == "..", F.lit(2))
        .when(F.startswith(name, F.lit(".")), F.lit(3)).otherwise(F.lit(4))
    )
    return F.struct(
        dots.alias("dots"), _run_key(stem).alias("stem"), _run_key(name).alias("whole"), name.alias("name")
    )


# ASCII characters that sort after all letters.
_AFTER_LETTERS = "".join(chr(c) for c in range(1, 127) if not chr(c).isalnum() and chr(c) != "~")


def _run_key(text: Column) -> Column:
    """Digit runs as length and digits, other runs as letters before symbols."""
    runs = F.regexp_extract_all(text, F.lit("([0-9]+|[^0-9]+)"), F.lit(1))
    symbols = _AFTER_LETTERS + "~"
    moved = "".join(chr(ord(c) + 256) for c in _AFTER_LETTERS) + "\x01"

    def key(run: Column) -> Column:
        digits = F.regexp_replace(run, "^0+", "")
        number = F.concat(F.lit("\x03"), F.lpad(F.length(digits).cast("string"), 5, "0"), digits)
        return F.when(run.rlike("^[0-9]"), number).otherwise(F.translate(run, symbols, moved))

    end = F.when(text.rlike("[0-9]$"), F.lit("\x02")).otherwise(F.lit("\x0300000\x02"))
    return F.concat(F.array_join(F.transform(runs, key), ""), end)


def _drop_tail(text: Column, tail: Column) -> Column:
    return F.substring(text, F.lit(1), F.length(text) - F.length(tail))


def _unquote(value: Column) -> Column:
    inner = F.substring(value, F.lit(2), F.length(value) - F.lit(2))
    return F.when(F.startswith(value, F.lit('"')), F.regexp_replace(inner, r"\\(.)", "$1")).otherwise(value)


def _percent_decoded(value: Column) -> Column:
    """``charset'lang'text``, or plain percent-coded text as later continuations have it."""
    charset = F.lower(F.regexp_extract(value, r"^([^']*)'[^']*'", 1))
    coded = F.regexp_replace(F.regexp_replace(value, r"^[^']*'[^']*'", ""), r"\+", "%2B")
    utf8 = F.try_url_decode(coded)
    return F.when(charset == "iso-8859-1", _latin1_decoded(coded)).otherwise(utf8)


def _latin1_decoded(coded: Column) -> Column:
    parts = F.regexp_extract_all(coded, F.lit("(%[0-9a-fA-F]{2}|[^%]+|%)"), F.lit(1))
    return F.array_join(
        F.transform(
            parts,
            lambda p: F.when(
                p.rlike("^%[0-9a-fA-F]{2}$"), F.decode(F.unhex(F.substring(p, F.lit(2), F.lit(2))), "ISO-8859-1")
            ).otherwise(p),
        ),
        "",
    )
