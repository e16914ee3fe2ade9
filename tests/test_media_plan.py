"""Entry 4 from the CSV file to the sheets."""

import csv
import datetime as dt

import pytest

from touchpath.config import MediaChannel, MediaConfig
from touchpath.plans.media import run_media

CFG = MediaConfig(perimeter=(dt.date(2021, 1, 4), dt.date(2022, 12, 31)),
                  years=(("year1", dt.date(2021, 1, 4), dt.date(2022, 1, 2)), ("year2", dt.date(2022, 1, 3), dt.date(2022, 12, 31))),
                  channels=(MediaChannel("Paid Search", "search", ("brand", "generic", "tot"), ("num", "inv")),
                            MediaChannel("Off TV", "off_tv", ("spot", "tot"), ("grp", "imp", "inv"))))


def weeks(path, header):
    rows = []
    for i in range(110):  # from before the perimeter to after it
        day = dt.date(2020, 12, 27) + dt.timedelta(weeks=i)
        values = {c: (i % 7 + 1) * (j + 1) for j, c in enumerate(header[1:])}
        rows.append([day.strftime("%d/%m/%Y"), *values.values()])
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([header, *rows])
    return rows


def test_from_csv_to_sheets(spark, tmp_dir):
    path = f"{tmp_dir}/weekly.csv"
    assert CFG.csv_columns == ["week_end_date", "search_brand_num", "search_brand_inv", "search_generic_num", "search_generic_inv", "search_tot_num",
                               "search_tot_inv", "off_tv_spot_grp", "off_tv_spot_imp", "off_tv_spot_inv", "off_tv_tot_grp", "off_tv_tot_imp", "off_tv_tot_inv"]
    rows = weeks(path, CFG.csv_columns)
    sheets = run_media(spark, path, CFG, f"{tmp_dir}/report")
    assert set(sheets) == {"Paid Search", "Off TV"}
    got = {(r.year_rolling, r.split): r for r in sheets["Paid Search"].collect()}
    assert set(got) == {(y, s) for y in ("year1", "year2") for s in ("BRAND", "GENERIC", "TOT")}
    cost = {}
    for day, *v in rows:
        when = dt.datetime.strptime(day, "%d/%m/%Y").date()
        for label, start, end in CFG.years:
            if start <= when <= end:
                cost[label] = cost.get(label, 0) + v[1]
    for label in ("year1", "year2"):
        assert got[label, "BRAND"].cost == cost[label]
        assert got[label, "TOT"].cost_perc == 1 and got[label, "BRAND"].cost_perc == pytest.approx(2 / 6)
    for name, folder in (("Paid Search", "Paid_Search"), ("Off TV", "Off_TV")):
        written = spark.read.csv(f"{tmp_dir}/report/{folder}", header=True)
        assert written.count() == sheets[name].count() and written.columns == sheets[name].columns


def test_a_file_with_other_columns_is_refused(spark, tmp_dir):
    path = f"{tmp_dir}/weekly.csv"
    weeks(path, [*CFG.csv_columns[:-1], "off_tv_tot_other"])
    with pytest.raises(Exception):
        run_media(spark, path, CFG)["Off TV"].collect()
