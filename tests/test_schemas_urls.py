import json
import random
import urllib.parse as up

import pytest
from pyspark.sql import functions as F

from textlake.functions import analysis, json_schema as J, text as X


def plain(schema, v):
    """Whether a value is as a schema says, from the definition."""
    kinds = {"string": str, "number": (int, float), "array": list, "object": dict, "boolean": bool, "null": type(None)}
    t = schema.get("type")
    if t == "integer":
        if isinstance(v, bool) or not isinstance(v, (int, float)) or v != int(v):
            return False
    elif t and (not isinstance(v, kinds[t]) or isinstance(v, bool) and t != "boolean"):
        return False
    number = isinstance(v, (int, float)) and not isinstance(v, bool)
    tests = [
        "enum" not in schema or any(type(x) is type(v) and x == v for x in schema["enum"]),
        not number or schema.get("minimum", v) <= v <= schema.get("maximum", v),
        not isinstance(v, str) or schema.get("minLength", 0) <= len(v) <= schema.get("maxLength", len(v)),
        not isinstance(v, list) or schema.get("minItems", 0) <= len(v) <= schema.get("maxItems", len(v)) and all(plain(schema.get("items", {}), x) for x in v),
        not isinstance(v, dict) or set(schema.get("required", [])) <= set(v) and (schema.get("additionalProperties", True) or set(v) <= set(schema["properties"])) and all(plain(s, v[k]) for k, s in schema.get("properties", {}).items() if k in v),
    ]
    return all(tests)


def plain_errors(schema, raw):
    try:
        v = json.loads(raw) if raw is not None else None
    except ValueError:
        v = None
    is_object, v = isinstance(v, dict), v if isinstance(v, dict) else {}
    out = [] if is_object else ["not_an_object"]
    out += ["missing_fields"] * (not set(schema["required"]) <= set(v)) + ["unknown_fields"] * (not set(v) <= set(schema["properties"]))
    return out + [k for k, s in schema["properties"].items() if not (plain(s, v[k]) if k in v else k not in schema["required"])]


def some_value(rng, schema, depth=0):
    odd = [None, True, 0, 1.5, -3, "", "x", "y" * 100, [], {}, [1], ["ok", 5], {"a": 1}, 7, "é" * 80]
    if rng.random() < 0.01:
        return rng.choice(odd)
    if "enum" in schema:
        return rng.choice([*schema["enum"], "other"]) if rng.random() < 0.03 else rng.choice(schema["enum"])
    kind = schema.get("type")
    if kind == "number":
        return rng.choice([schema["minimum"], schema["maximum"], 0.25, 1, 1e-3, schema["maximum"] + 0.01] if rng.random() < 0.1 else [0.5, 0, 1])
    if kind == "string":
        return "z" * rng.choice([1, schema.get("maxLength", 5), schema.get("maxLength", 5) + 1] if rng.random() < 0.05 else [3])
    if kind == "array":
        return [some_value(rng, schema["items"], depth + 1) for _ in range(rng.randint(schema.get("minItems", 0), schema["maxItems"] + (rng.random() < 0.03)))]
    out = {k: some_value(rng, s, depth + 1) for k, s in schema["properties"].items() if rng.random() > 0.01}
    return out | ({"extra": 1} if rng.random() < 0.02 else {})


@pytest.mark.parametrize("version", [1, 2, 3])
def test_versions_against_plain_python(spark, version):
    schema, rng = analysis.schema_document(version), random.Random(version)
    raws = [json.dumps(some_value(rng, schema)) for _ in range(250)] + [None, "", "no json", "[1]", '"x"', "null", "{}", '{"summary": "a", "summary": "b"}', "{\"topics\": ["]
    rows = spark.createDataFrame(list(enumerate(raws)), "i int, raw string").select("raw", analysis.schema_errors(F.col("raw"), version).alias("e")).collect()
    seen = {True: 0, False: 0}
    for r in rows:
        want = plain_errors(schema, r.raw) if r.raw != '{"summary": "a", "summary": "b"}' else plain_errors(schema, None)
        assert r.e == want, r.raw
        seen[not r.e] += 1
    assert seen[True] > 20 and seen[False] > 50


def test_keywords(spark):
    one = lambda schema, *values: [r[0] for r in spark.createDataFrame([(json.dumps(v),) for v in values], "raw string").select(J.compiled(schema)(F.try_parse_json("raw"))).collect()]
    assert one({"type": "integer"}, 1, 1.0, 1.5, "1", True) == [True, True, False, False, False]
    assert one({"type": ["string", "null"]}, "a", None, 1) == [True, True, False]
    assert one({"const": 2}, 2, 2.0, "2") == [True, True, False]
    assert one({"exclusiveMinimum": 0, "exclusiveMaximum": 1}, 0, 0.5, 1, "x") == [False, True, False, True]
    assert one({"pattern": "^a+$"}, "aa", "ab", 3) == [True, False, True]
    assert one({"uniqueItems": True}, [1, 2], [1, 1], [{"a": 1}, {"a": 1}]) == [True, False, False]
    assert one({"items": {"items": {"type": "boolean"}}}, [[True], []], [[1]], 5) == [True, False, True]
    with pytest.raises(ValueError, match="unknown keyword"):
        J.compiled({"oneOf": []})
    with pytest.raises(ValueError, match="unknown types"):
        J.compiled({"type": "text"})


def brute(url):
    parts = up.urlsplit(url.strip())
    host, port = (parts.hostname or "").lower(), parts.port
    if port and (parts.scheme.lower(), port) not in (("http", 80), ("https", 443)):
        host += f":{port}"
    pairs = [(k, v) for k, v in up.parse_qsl(parts.query, keep_blank_values=True) if k.casefold() not in X.TRACKING and not k.casefold().startswith("utm_")]
    return f"{parts.scheme.lower()}://{host}{parts.path or '/'}" + (f"?{up.urlencode(sorted(pairs))}" if pairs else "")


def test_percent_coding_against_brute_force(spark):
    rng = random.Random(4)
    bits = ["a", "B", "=", "&", "+", " ", "%20", "%2B", "%C3%A9", "%c3%a9", "é", "%", "%z", "%4", "%FF", "%C3", "%E2%82", "%E2%82%AC", "%F0%9F%98%80", "😀", "*", "~", "%7E", "%2a", "-", ".", "_", ";", "/", "?", "@", ":", "utm_x", "UTM%5Fy=1", "fbclid", "&&", "==", "漢", "%00", "'", '"', "<", "%26", "%3D"]
    urls = ["http://h/?" + "".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(1500)]
    urls += ["HTTP://user:pw@Host.COM:0080/p;x=1?b=1&b=0&a#f?x=1", "https://h:443", "https://h:8443/a%2Fb?q", "http://h:/x", "http://h:0/x", " \thttp://h/ ", "http://h/a?x=1#?y=2", "http://h/#a?b=1", "ftp://h:80/", "http://h/?a=1;b=2"]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", X.canonical_url(F.col("u")).alias("c")).collect()
    for r in rows:
        assert r.c == brute(r.u), r.u
    again = spark.createDataFrame([(r.c,) for r in rows], "u string").select("u", X.canonical_url(F.col("u")).alias("c")).collect()
    assert all(r.u == r.c for r in again)


def test_percent_coding_has_no_python(spark):
    plan = spark.createDataFrame([("x",)], "u string").select(X.canonical_url(F.col("u")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
