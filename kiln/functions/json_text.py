"""JSON text as Python's ``json.dumps(json.loads(text))`` writes it, as a Column expression.

Keys stay in their order at every depth; ``", "`` and ``": "`` separate; everything outside of printable ASCII is
escaped (``\\uXXXX``, surrogate pairs beyond the first plane); floats are written as Python's ``repr``, whole numbers of any
size as they are. The text is cut into its tokens and each is rewritten on its own, so no map type sorts or flattens
what it holds. Text that is not JSON gives tokens all the same: check it first (``try_parse_json``). An object that
names a key twice keeps both.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = r'("[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}\[\],:]|[^\s{}\[\],:"]+)'
SHORT = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\f": "\\f", "\b": "\\b"}


def _unit(n: Column) -> Column:
    return F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(n), 4, "0")))


def _char(c: Column) -> Column:
    n = F.ascii(c)
    out = F.when((n >= 32) & (n <= 126), c).when(n < 65536, _unit(n))
    out = out.otherwise(F.concat(_unit(F.shiftright(n - 65536, 10) + 0xD800), _unit((n - 65536).bitwiseAND(F.lit(1023)) + 0xDC00)))
    for k, v in SHORT.items():
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


def quoted(text: Column) -> Column:
    """A string as a JSON literal."""
    plain = F.concat(F.lit('"'), text, F.lit('"'))
    escaped = F.concat(F.lit('"'), F.array_join(F.transform(F.split(text, ""), _char), ""), F.lit('"'))
    return F.when(text.rlike(r"\A[ !#-\[\]-~]*\z"), plain).otherwise(escaped)


def _string(token: Column) -> Column:
    decoded = F.from_json(F.concat(F.lit("["), token, F.lit("]")), "array<string>")[0]
    return F.when(token.rlike(r'\A"[ !#-\[\]-~]*"\z'), token).otherwise(quoted(decoded))


def _float(token: Column) -> Column:
    """``repr`` of the double: digits as they are from 1e-4 up to 1e16, else with an exponent of two digits or more."""
    text = token.cast("double").cast("string")
    sign = F.regexp_extract(text, r"\A(-?)", 1)
    digits = F.regexp_replace(F.regexp_replace(F.regexp_extract(text, r"\A-?([0-9.]+)", 1), r"\.", ""), r"(?<=.)0+\z", "")
    e = F.regexp_extract(text, r"E(-?[0-9]+)\z", 1).cast("int")
    size = F.length(digits)
    point = F.when(size > e + 1, F.concat(F.substring(digits, F.lit(1), e + 1), F.lit("."), F.substring(digits, e + 2, F.lit(400))))
    point = point.otherwise(F.concat(F.rpad(digits, e + 1, F.lit("0")), F.lit(".0")))
    power = F.concat(F.when(e < 0, F.lit("e-")).otherwise(F.lit("e+")), F.lpad(F.abs(e).cast("string"), F.greatest(F.lit(2), F.length(F.abs(e).cast("string"))), F.lit("0")))
    far = F.concat(F.substring(digits, 1, 1), F.when(size > 1, F.concat(F.lit("."), F.substring(digits, 2, 400))).otherwise(F.lit("")), power)
    near = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    return F.when(~text.contains("E"), text).otherwise(F.concat(sign, F.when((e >= 16) | (e < -4), far).when(e < 0, near).otherwise(point)))


def _token(t: Column) -> Column:
    return (
        F.when(t == ",", F.lit(", ")).when(t == ":", F.lit(": ")).when(t.startswith('"'), _string(t)).when(t == "-0", F.lit("0"))
        .when(t.rlike(r"\A-?[0-9]+[.eE]"), _float(t)).otherwise(t)
    )


def python_json(text: Column) -> Column:
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(1)), _token), "")
