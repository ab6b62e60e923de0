"""The streamed silver layer."""
