"""Values the tests share. They are not in conftest, because a test may meet the conftest of another folder."""

TESTDATA = "/root/testdata"

#: Changes to an ordinary completed flight.
LATE = {"ARR_DEL15": "1.00", "ARR_DELAY": "20.00", "ARR_DELAY_NEW": "20.00"}
CANCELLED = {"CANCELLED": "1.00", "CANCELLATION_CODE": "A", "DEP_TIME": None, "DEP_DELAY": None, "DEP_DEL15": None,
             "ARR_TIME": None, "ARR_DELAY": None, "ARR_DELAY_NEW": None, "ARR_DEL15": None}
