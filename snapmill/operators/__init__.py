"""DataFrame to DataFrame operators. All of them are lazy unless they say otherwise."""
