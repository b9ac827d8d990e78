"""The end-to-end job (``pipeline``), named queries (``catalog``) and their SQL oracle (``oracle``)."""
