"""Training-data operators: joins of similar texts, filters, packing, mixing, scoring, archives."""
