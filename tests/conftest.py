import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from helpers import ORDER_ROWS, RECEIPT_ROWS, lines  # noqa: E402

from clickloom.session import ROCKSDB, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(
        4,
        2,
        spark__sql__streaming__stateStore__providerClass=ROCKSDB,
        spark__checkpoint__dir="/tmp/clickloom-tests",
    )


@pytest.fixture(scope="session")
def order_files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("orders")
    (folder / "orders.csv").write_text(lines(ORDER_ROWS))
    (folder / "receipts.csv").write_text(lines(RECEIPT_ROWS))
    return str(folder / "orders.csv"), str(folder / "receipts.csv")
