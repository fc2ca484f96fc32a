import json

import pytest

from granulake.operators.messages import parse_messages

# Announcements as the store sends them, reduced to the fields that matter.
L1B = "ABI-L1b-RadF/2020/188/06/OR_ABI-L1b-RadF-M6C16_G16_s20201880600226.nc"
CMIP = "ABI-L2-CMIPM/2020/188/08/OR_ABI-L2-CMIPM2-M6C16_G16_s20201880858571.nc"
MCMIP = "ABI-L2-MCMIPM/2020/188/08/OR_ABI-L2-MCMIPM2-M6_G16_s20201880858571.nc"
GLM = "GLM-L2-LCFA/2020/188/06/OR_GLM-L2-LCFA_G16_s20201880615000.nc"
OTHER = "OR_ABI-L2-DSIM1-M6_G16_s20193391559242.nc"


def message(name, **changes):
    return json.dumps({"id": f"b/{name}/1", "name": name, "size": "12"} | changes)


STRICT = [
    '{"name":"ABI-L1b","id":"i","size":"1"}',
    ' {"name":"ABI-L1b","id":NaN}\n',
    '{"name":"ABI-L1b","id":null}',
    '{"name":"x","id":1,"name":"ABI-L1b"}',
    '{"name":"ABI-L1b","id":{"x":[1,2]},"size":null}',
    '{"name":"\\u0041BI-L1b","id":1}',
    '{"w":1,"name":"ABI-L1b","id":1}',
    '{"other":[1,{"name":"q"}],"name":"ABI-L1b","id":1}',
    '{"other":1e999,"name":"ABI-L1b","id":1}',
    '{"name":"ABI-L1b","id":"i"} x',
    '{"name":"ABI-L1b","id":"i"}}',
    '[{"name":"ABI-L1b","id":"i"}]',
    '{"name":5,"id":1}',
    '{"name":null,"id":1}',
    '{"name":["ABI-L1b"],"id":1}',
    '{"name":{"ABI-L1b":1},"id":1}',
    '{"name":"ABI-L1b"}',
    "{'name':'ABI-L1b','id':'i'}",
    '{"Name":"ABI-L1b","id":1}',
    '{"name":"ABI-L1b","id":1} ]',
    '{"name":"ABI-L1b","id":1}] x',
    '{"name":"ABI-L1b","id":1},{"name":"ABI-L1b","id":2}',
    '{"name":"ABI-L1b","id":1},"w":{"name":"ABI-L1b","id":1}',
    '{"name":"ABI-L1b","id":1}}] {',
    '{"name":"ABI-L1b\t","id":1}',
    '{"name":"ABI-L1b","id":1,}',
    '{"name":"ABI-L1b","id":01}',
    '{"name":"ABI-L1b","id":1',
    '{"name":"ABI-L1b","id":1}/*c*/',
    "",
    "null",
    "5",
    '"ABI-L1b"',
]


def well_formed(text):
    try:
        value = json.loads(text)
    except ValueError:
        return False
    return isinstance(value, dict) and isinstance(value.get("name"), str) and "id" in value


def verdicts(spark, texts):
    rows = parse_messages(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    return {row.value: row for row in rows}


def test_samples(spark):
    texts = {name: message(name) for name in (L1B, CMIP, MCMIP, GLM, OTHER)}
    rows = verdicts(spark, texts.values())
    assert {name: (rows[t].verdict, rows[t].table_name) for name, t in texts.items()} == {
        L1B: ("kept", "abi_l1b_radiance"),
        CMIP: ("kept", "abi_l2_cmip"),
        MCMIP: ("kept", "abi_l2_mcmip"),
        GLM: ("kept", "glm_l2_lcfa"),
        OTHER: ("skipped", None),
    }


def test_strict_json_like_a_strict_parser(spark):
    rows = verdicts(spark, STRICT)
    assert {t: rows[t].verdict == "kept" for t in STRICT} == {t: well_formed(t) for t in STRICT}


def test_null_text_is_malformed(spark):
    assert verdicts(spark, [None])[None].verdict == "malformed"


@pytest.mark.parametrize(
    ("name", "table"),
    [
        ("x/ABI-L2-MCMIP-and-ABI-L1b.nc", "abi_l1b_radiance"),
        ("deep/GLM-L2-LCFA", "glm_l2_lcfa"),
        ("abi-l1b/lower.nc", None),
    ],
)
def test_first_route_anywhere_in_the_name_case_sensitive(spark, name, table):
    text = message(name)
    assert verdicts(spark, [text])[text].table_name == table


def test_an_unwanted_object_without_id_is_skipped_not_malformed(spark):
    text = json.dumps({"name": OTHER})
    assert verdicts(spark, [text])[text].verdict == "skipped"


def test_sizes(spark):
    texts = {size: message(L1B, size=size) for size in ("7", 7, None)}
    rows = verdicts(spark, texts.values())
    assert [(rows[t].size, rows[t].size_given) for t in texts.values()] == [
        ("7", True),
        ("7", True),
        (None, True),
    ]
    absent = json.dumps({"name": L1B, "id": 1})
    assert verdicts(spark, [absent])[absent].size_given is False


def test_each_message_is_parsed_once(spark):
    """The filter reads the parsed field instead of copying the parse."""
    parsed = parse_messages(spark.createDataFrame([("{}",)], "value string"))
    plan = parsed.filter("verdict = 'kept'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(ArrayType") == 1
