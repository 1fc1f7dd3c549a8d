"""End-to-end layered jobs (bronze -> silver -> gold) built from the operators."""
