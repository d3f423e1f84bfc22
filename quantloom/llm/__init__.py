"""Training-data operators: one module each, plus ``queries`` with the registered queries."""
