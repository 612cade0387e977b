"""The user-facing answers, composed from the operators."""
