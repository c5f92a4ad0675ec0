"""Terms and scalar functions as column expressions."""
