"""Text rules on columns: trimming, sizes, timestamps, names, licences, versions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

# The characters Unicode counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Factor of each size unit; any other unit counts single bytes.
SIZE_UNITS = {"kB": 1024, "KB": 1024, "MB": 1024 ** 2, "GB": 1024 ** 3}

# SPDX licence identifiers in common use on the index.
SPDX_IDS = (
    "0BSD", "AFL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-1.1", "Apache-2.0",
    "Artistic-1.0", "Artistic-2.0", "BlueOak-1.0.0", "BSD-1-Clause", "BSD-2-Clause",
    "BSD-2-Clause-Patent", "BSD-3-Clause", "BSD-3-Clause-Clear", "BSD-3-Clause-LBNL",
    "BSD-4-Clause", "BSL-1.0", "CAL-1.0", "CC-BY-3.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0",
    "CDDL-1.0", "CECILL-2.1", "CECILL-B", "CECILL-C", "CNRI-Python", "CPL-1.0", "ECL-2.0",
    "EFL-2.0", "EPL-1.0", "EPL-2.0", "EUPL-1.1", "EUPL-1.2", "FSFAP", "FTL", "GFDL-1.3-only",
    "GFDL-1.3-or-later", "GPL-1.0-only", "GPL-1.0-or-later", "GPL-2.0-only", "GPL-2.0-or-later",
    "GPL-3.0-only", "GPL-3.0-or-later", "HPND", "ICU", "IPL-1.0", "ISC", "LGPL-2.0-only",
    "LGPL-2.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "LPPL-1.3c", "MIT", "MIT-0", "MIT-CMU", "MPL-1.0", "MPL-1.1", "MPL-2.0",
    "MPL-2.0-no-copyleft-exception", "MS-PL", "MS-RL", "MulanPSL-2.0", "NCSA", "NTP", "ODbL-1.0",
    "OFL-1.1", "OpenSSL", "OSL-3.0", "PHP-3.01", "PostgreSQL", "PSF-2.0", "Python-2.0",
    "Python-2.0.1", "QPL-1.0", "RPL-1.5", "Ruby", "SISSL", "Sleepycat", "SSPL-1.0",
    "TCL", "Unicode-3.0", "Unicode-DFS-2016", "Unlicense", "UPL-1.0", "Vim", "W3C",
    "WTFPL", "X11", "Zlib", "ZPL-2.0", "ZPL-2.1",
)

# SPDX exception identifiers that may follow WITH.
SPDX_EXCEPTIONS = (
    "Autoconf-exception-3.0", "Bison-exception-2.2", "Classpath-exception-2.0",
    "Font-exception-2.0", "GCC-exception-3.1", "LLVM-exception", "OCaml-LGPL-linking-exception",
    "OpenJDK-assembly-exception-1.0", "Qt-GPL-exception-1.0", "Swift-exception",
)

# One clause of a Python version requirement: operator, then a version; a
# trailing wildcard is allowed with == and != only, and === takes any text.
_RELEASE = r"v?(\d+!)?\d+(\.\d+)*"
_SUFFIX = r"([-_.]?(a|b|c|rc|alpha|beta|pre|preview)[-_.]?\d*)?(-\d+|[-_.]?(post|rev|r)[-_.]?\d*)?([-_.]?dev[-_.]?\d*)?"
_LOCAL = r"(\+[a-z0-9]+([-_.][a-z0-9]+)*)?"
_CLAUSE = (
    r"(?i)^\s*(===\s*\S+"
    rf"|(==|!=)\s*{_RELEASE}(\.\*|{_SUFFIX}{_LOCAL})"
    rf"|~=\s*v?(\d+!)?\d+(\.\d+)+{_SUFFIX}"
    rf"|(<=|>=|<|>)\s*{_RELEASE}{_SUFFIX})\s*$"
)

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_STAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}([.,]\d+)?(Z|[+-]\d{2}:?\d{2})$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times within ``body``.

    The end of a fold over nothing: an array's element would be copied, and its type worked out again, for each row.
    """
    return F.aggregate(F.expr("cast(array() as array<int>)"), value, lambda acc, _: acc, body)


def strip_space(text: Column) -> Column:
    """Trim every kind of Unicode white space, not only blanks."""
    return F.btrim(text, F.lit(WHITESPACE))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def non_blank(text: Column) -> Column:
    """``blank_to_null`` for a costly expression, which is evaluated once only."""
    return F.get(F.filter(F.array(text), lambda t: t != ""), 0)


def fold_case(text: Column) -> Column:
    """Case-blind key: lower case, with sharp s, final sigma and long s folded as well."""
    return F.replace(F.translate(F.lower(text), "\u03c2\u017f", "\u03c3s"), F.lit("\u00df"), F.lit("ss"))


def parse_size(text: Column) -> Column:
    """'1.2 kB' to bytes, cut to a whole number; text without a number gives 0."""
    units = F.create_map(*[F.lit(x) for pair in SIZE_UNITS.items() for x in pair])

    def size(words: Column) -> Column:
        number = F.when(F.get(words, 0).rlike(_NUMBER), F.get(words, 0).try_cast("double"))
        factor = F.coalesce(F.try_element_at(units, F.get(words, 1)), F.lit(1))
        return (number * factor).try_cast("bigint")

    return F.coalesce(let(F.split(strip_space(text), f"[{WHITESPACE}]+"), size), F.lit(0).cast("bigint"))


def parse_timestamp(text: Column) -> Column:
    """ISO 8601 with T and an offset (Z, +hh:mm or +hhmm), fraction optional; other text gives null."""
    return F.when(text.rlike(_STAMP), F.replace(text, F.lit(","), F.lit(".")).try_cast("timestamp"))


def normalized_name(name: Column) -> Column:
    """PEP 503 form: runs of - _ . become one dash, lower case."""
    return F.lower(F.regexp_replace(name, r"[-_.]+", "-"))


def package_type(filename: Column) -> Column:
    return F.when(filename.endswith(".whl"), F.lit("wheel")).otherwise(F.lit("sdist"))


def is_valid_requires_python(spec: Column) -> Column:
    """True when every comma-separated clause is a PEP 440 specifier; null stays null.

    Blank clauses, as a trailing comma leaves them, are passed over as installers do.
    """
    some = strip_space(F.translate(spec, ",", "")) != ""
    return some & F.forall(F.split(spec, ","), lambda clause: clause.rlike(_CLAUSE) | (strip_space(clause) == ""))


def license_tokens(expression: Column) -> Column:
    return F.regexp_extract_all(expression, F.lit(r"([()]|[^\s()]+)"), 1)


def license_marks(token: Column, known: Column, exception: Column) -> Column:
    """One letter per token: brackets, & and + for the operators, L licence, E exception, ? unknown."""
    return (
        F.when(token.isin("(", ")"), token)
        .when(token.isin("AND", "OR", "and", "or"), F.lit("&"))
        .when(token.isin("WITH", "with"), F.lit("+"))
        .when(known | token.rlike(r"^LicenseRef-[A-Za-z0-9.-]+$"), F.lit("L"))
        .when(exception, F.lit("E"))
        .otherwise(F.lit("?"))
    )


def well_formed_license(marks: Column) -> Column:
    """Whether a row of marks is an expression: one pass follows what may come next and how deep the brackets are."""

    def follow(acc: Column, m: Column) -> Column:
        """``state``: o operand awaited, x exception awaited, l after a licence, d after anything closed, ? wrong."""
        state, depth = acc["state"], acc["depth"]
        step = (
            F.when((state == "o") & (m == "L"), "l").when((state == "o") & (m == "("), "o")
            .when((state == "x") & (m == "E"), "d")
            .when((state == "l") & (m == "+"), "x")
            .when(state.isin("l", "d") & (m == "&"), "o")
            .when(state.isin("l", "d") & (m == ")") & (depth > 0), "d").otherwise("?")
        )
        deeper = depth + F.when(m == "(", 1).when(m == ")", -1).otherwise(0)
        return F.struct(step.alias("state"), deeper.alias("depth"))

    start = F.struct(F.lit("o").alias("state"), F.lit(0).alias("depth"))
    return F.aggregate(marks, start, follow, lambda end: end["state"].isin("l", "d") & (end["depth"] == 0))


def is_valid_spdx_license(
    expression: Column, ids: Sequence[str] = SPDX_IDS, exception_ids: Sequence[str] = SPDX_EXCEPTIONS
) -> Column:
    """True when the text is a well-formed SPDX expression over the given identifiers.

    The default identifiers are the common ones; the whole published list comes as a table
    (``operators.licenses.valid_licenses``).
    """
    known = F.array(*[F.lit(i.lower()) for i in ids])
    exceptions = F.array(*[F.lit(i.lower()) for i in exception_ids])

    def mark(token: Column) -> Column:
        bare = F.lower(F.regexp_replace(token, r"\+$", ""))
        return license_marks(token, F.array_contains(known, bare), F.array_contains(exceptions, F.lower(token)))

    return well_formed_license(F.transform(license_tokens(expression), mark))
