"""Reading source tables in numbered batches, and staging and publishing the result."""
