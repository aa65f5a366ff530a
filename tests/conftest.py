import pytest

from assaylake import Reference, rules_from
from assaylake.session import build_session
from tests import fixture_data as fx


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "assaylake-tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def landing(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    for name, text in fx.CSVS.items():
        (folder / f"{name}.csv").write_text(text)
    rules, mappings = fx.catalogue_json()
    (folder / "rules.json").write_text(rules)
    (folder / "mappings.json").write_text(mappings)
    return folder


@pytest.fixture(scope="session")
def tables(spark, landing):
    from assaylake.sources.tables import read_csv

    out = {n: read_csv(spark, str(landing / f"{n}.csv"), fx.SCHEMAS[n]) for n in fx.CSVS}
    out["dim_country"] = spark.createDataFrame([(c,) for c in fx.COUNTRIES], "country_code string")
    return out


@pytest.fixture(scope="session")
def refs(tables):
    return {"dim_country": Reference(tables["dim_country"]), "customers": Reference(tables["customers"])}


@pytest.fixture(scope="session")
def rules():
    return {n: rules_from(fx.rule_entries(n)) for n in fx.CSVS}
