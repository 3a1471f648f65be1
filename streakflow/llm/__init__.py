"""Training-data operators: one module per operator, thin queries in
``queries.py``. Nothing outside this subpackage imports it except the guarded
hook of the driver contract and the corpus pipeline."""
