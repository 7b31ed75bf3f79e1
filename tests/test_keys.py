import pytest

from conftest import SF_SMALL, plan_text
from tidewater.sources.keys import GlobError, glob_to_regex, key_scan, keyed_view, literal_prefix

KEYS = ["shop:1", "shop:12", "shop:a", "shop:*", "Shop:1", "shop:\n1", "shop:1.2", "shop:(x)", "shop:[1]",
        "shop:a&b", "shop:^1", "shop:-", "shop:1\n"]


@pytest.fixture()
def kv_store(spark):
    return spark.createDataFrame([(k, f"v{i}") for i, k in enumerate(KEYS)], "key string, value string")


def scan(df, pattern):
    return sorted(r.key for r in key_scan(df, pattern).collect())


@pytest.mark.parametrize(
    "pattern, expected",
    [
        ("shop:*", sorted(k for k in KEYS if k.startswith("shop:"))),
        ("shop:?", sorted(["shop:1", "shop:a", "shop:*", "shop:-"])),
        ("shop:1", ["shop:1"]),
        ("shop:1*", sorted(["shop:1", "shop:12", "shop:1.2", "shop:1\n"])),
        ("shop:[0-9]", ["shop:1"]),
        ("shop:[9-0]", ["shop:1"]),
        ("shop:[^0-9]", sorted(["shop:a", "shop:*", "shop:-"])),
        ("shop:\\*", ["shop:*"]),
        ("shop:1.2", ["shop:1.2"]),
        ("shop:(x)", ["shop:(x)"]),
        ("shop:\\[1]", ["shop:[1]"]),
        ("shop:a&b", ["shop:a&b"]),
        ("shop:[&]*", ["shop:a&b"][:0]),
        ("shop:^1", ["shop:^1"]),
        ("shop:?1", sorted(["shop:\n1", "shop:^1"])),
        ("Shop:*", ["Shop:1"]),
        ("*:1", sorted(["shop:1", "Shop:1"])),
        ("shop:[-]", ["shop:-"]),
    ],
)
def test_glob_semantics(kv_store, pattern, expected):
    assert scan(kv_store, pattern) == expected


def test_trailing_newline_is_not_ignored(kv_store):
    # '$' in Java regex would also match before a final newline; \z does not.
    assert "shop:1\n" not in scan(kv_store, "shop:1")


def test_unterminated_class():
    with pytest.raises(GlobError):
        glob_to_regex("shop:[12")


def test_literal_prefix():
    assert literal_prefix("cust:1?[57]*") == "cust:1"
    assert literal_prefix("a\\*b*") == "a*b"
    assert literal_prefix("*x") == ""


def test_prefix_pushed_for_stored_key(spark, tmp_path):
    c = keyed_view(spark.read.parquet(f"{SF_SMALL}/customer.parquet"), "cust:", ["c_custkey"])
    path = str(tmp_path / "kv")
    c.write.parquet(path)
    plan = plan_text(key_scan(spark.read.parquet(path), "cust:1?[57]*"))
    assert "StringStartsWith(key,cust:1)" in plan


def test_keys_only(kv_store):
    assert key_scan(kv_store, "shop:a", keys_only=True).columns == ["key"]
