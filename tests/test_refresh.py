import pytest

from wattframe.plans import serving
from wattframe.plans.refresh import clean_path, refresh, table_path
from wattframe.sources.catalog import SOURCES, TABLES
from wattframe.sources.files import read_table


def land(base, source, name, text):
    folder = base / SOURCES[source].raw_prefix
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_refresh_from_raw_files(spark, tmp_path):
    head = "period,stateId,stateDescription,seriesId,seriesDescription,value,unit\n"
    land(tmp_path, "seds", "seds_2021_to_2022.csv",
         head + "2021,TX,Texas,TETCB,t,100,u\n2022,TX,Texas,TETCB,t,150,u\n" * 2
         + "2022,US,United States,TETCB,t,9,u\n2022,TX,Texas,COTCB,c,NA,u\n")
    land(tmp_path, "seds", "seds_2022_to_2023.csv",
         "value,period,stateId,stateDescription,seriesId,seriesDescription,unit\n"
         "30,2023,TX,Texas,COTCB,c,u\n300,2023,TX,Texas,TETCB,t,u\n")
    land(tmp_path, "natural_gas", "natural_gas_all_to_all.csv",
         "period,duoarea,area-name,process,value\n2025-01,STX,TEXAS,VGM,30\n2025-02,STX,TEXAS,VGM,10\n"
         "2025-02,SOH,OHIO,VGM,30\n2025-03,SOH,OHIO,VGM,1\n")
    base = str(tmp_path)
    written = refresh(spark, base, ["seds", "natural_gas"])
    assert written == ["seds_state_consumption", "seds_state_pct_us", "seds_fuel_pivot", "ng_production"]
    assert read_table(spark, clean_path(base, "seds")).count() == 4

    change = read_table(spark, table_path(base, "seds_state_pct_us")).orderBy("year")
    assert [r["yoy_change_pct"] for r in change.collect()] == [None, 50.0, 100.0]
    mix = read_table(spark, table_path(base, "seds_fuel_pivot"))
    assert mix.where("year = 2023").first()["co_pct"] == 10.0

    spec = TABLES["ng_production"]
    rows = serving.load(spark, spec, f"{base}/processed")
    february = serving.time_slice(rows, spec, 2025, month=2)
    found = serving.states_only(serving.by_place(february, "pct_us_production"))
    assert sorted(tuple(r) for r in found.collect()) == [("Ohio", 75.0, "OH"), ("Texas", 25.0, "TX")]


def test_a_place_filter_reaches_the_scan(spark, tmp_path):
    land(tmp_path, "natural_gas", "x.csv",
         "period,duoarea,area-name,process,value\n2025-01,STX,TEXAS,VGM,1\n2025-01,SOH,Ohio,VGM,3\n")
    refresh(spark, str(tmp_path), ["natural_gas"])
    spec = TABLES["ng_production"]
    rows = serving.load(spark, spec, f"{tmp_path}/processed")
    one = serving.trend(rows, spec, "production_mmcf", place="Texas")
    assert [r["production_mmcf"] for r in one.collect()] == [1.0]
    assert "EqualTo(place,Texas)" in one._jdf.queryExecution().executedPlan().toString()


def test_a_range_never_replaces_the_history(spark, tmp_path):
    for out in (None, f"{tmp_path}/"):
        with pytest.raises(ValueError, match="out"):
            refresh(spark, str(tmp_path), ["natural_gas"], start="2025-03", out=out)


def test_refresh_of_a_range(spark, tmp_path):
    land(tmp_path, "natural_gas", "x.csv",
         "period,duoarea,area-name,process,value\n"
         + "".join(f"2025-{m:02d},STX,TEXAS,VGM,{m}\n" for m in range(1, 13)))
    base, out = str(tmp_path), str(tmp_path / "out")
    refresh(spark, base, ["natural_gas"], start="2025-03", end="2025-05", out=out)
    found = read_table(spark, table_path(out, "ng_production")).collect()
    assert sorted(r["production_mmcf"] for r in found) == [3.0, 4.0, 5.0]
    land(tmp_path, "coal", "x.csv",
         "period,exportImportType,coalRankId,coalRankDescription,countryId,countryDescription,"
         "customsDistrictId,customsDistrictDescription,quantity,price\n"
         + "".join(f"{y},exports,BIT,B,CA,Canada,1,one,{y},1\n" for y in range(2020, 2025)))
    refresh(spark, base, ["coal"], start="2021", end="2022", out=out)
    assert read_table(spark, table_path(out, "coal_trade")).count() == 2
