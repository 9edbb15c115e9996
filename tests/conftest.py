import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from keepwell import contract as C  # noqa: E402
from keepwell.session import checkpoint_dir, local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    session.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL


# A complete, unremarkable account; tests change single fields of it.
GOOD = dict(
    Customer_ID="A1", Gender="Male", Age=30, Married="Yes", Number_of_Dependents=1,
    City="X", Zip_Code=90001, Latitude=1.0, Longitude=2.0, Number_of_Referrals=3,
    Tenure_in_Months=24, Offer=None, Phone_Service="Yes",
    Avg_Monthly_Long_Distance_Charges=10.0, Multiple_Lines="No", Internet_Service="Yes",
    Internet_Type="DSL", Avg_Monthly_GB_Download=5.0, Online_Security="Yes",
    Online_Backup="No", Device_Protection_Plan="Yes", Premium_Tech_Support="No",
    Streaming_TV="Yes", Streaming_Movies="No", Streaming_Music="No", Unlimited_Data="Yes",
    Contract="One Year", Paperless_Billing="Yes", Payment_Method="Credit Card",
    Monthly_Charge=70.0, Total_Charges=1680.0, Total_Refunds=0.0,
    Total_Extra_Data_Charges=0.0, Total_Long_Distance_Charges=240.0,
    Total_Revenue=1920.0, Customer_Status="Stayed", Churn_Category=None, Churn_Reason=None,
)
NO_INTERNET = {"Internet_Service": "No", "Internet_Type": None, "Avg_Monthly_GB_Download": None,
               **{c: None for c in C.INTERNET_ADD_ONS}}
NO_PHONE = {"Phone_Service": "No", "Avg_Monthly_Long_Distance_Charges": None,
            "Multiple_Lines": None}


@pytest.fixture(scope="session")
def table(spark):
    """Builds an account table from changes to the good record."""
    def build(*changes, schema=C.ACCOUNT_SCHEMA):
        rows = []
        for i, change in enumerate(changes or ({},)):
            row = {**GOOD, "Customer_ID": f"A{i}", **change}
            rows.append(tuple(row[c] for c in C.COLUMNS))
        return spark.createDataFrame(rows, schema)
    return build
