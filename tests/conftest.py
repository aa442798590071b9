import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from daybook.session import local_session

    s = local_session("4", shuffle_partitions=8, app="daybook-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def samples():
    """Two raw samples of the input format (full month A, partial month B)."""
    a = {
        "item_number": "36904", "item_description": "Mccormick Vodka Pet", "cost": 1.76, "retail": 2.63,
        "volume_ml": 375, "pack_size": 24, "year_month": "2012-01",
        "dates_arr": ["2012-01-03", "2012-01-04", "2012-01-05", "2012-01-09", "2012-01-10", "2012-01-11", "2012-01-12",
                      "2012-01-16", "2012-01-17", "2012-01-18", "2012-01-19", "2012-01-23", "2012-01-24", "2012-01-25",
                      "2012-01-26", "2012-01-30", "2012-01-31"],
        "daily_bottles_sold_arr": ["570", "303", "922", "570", "573", "433", "889", "673", "923", "537", "1077", "735",
                                   "754", "554", "969", "639", "630"],
    }
    b = {
        "item_number": "68039", "item_description": "Baileys Original Irish Cream 100ml", "cost": 41.76,
        "retail": 62.64, "volume_ml": 2400, "pack_size": 4, "year_month": "2020-07",
        "dates_arr": ["2020-07-01", "2020-07-02", "2020-07-03", "2020-07-06", "2020-07-07", "2020-07-08", "2020-07-09",
                      "2020-07-13", "2020-07-15"],
        "daily_bottles_sold_arr": ["5", "2", "10", "8", "4", "8", "16", "6", "12"],
    }
    return a, b
